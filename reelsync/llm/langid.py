"""Language identification by prediction by partial matching (operator 6).

For every language a variable-order context tree over UTF-8 bytes (contexts of
0 to ``ORDER`` bytes) is counted on labelled texts and frozen. The code length
of a text under a language is the exact sum over its bytes: in the longest
context seen in training a known byte costs -log2(c / (T + q)) bits and the
escape to the next shorter context -log2(q / (T + q)), where c counts the byte,
T all bytes and q the different bytes after that context (escape method C);
below the empty context every byte costs 8 bits. The language with the
shortest code wins, ties go to the smaller name.

Since the statistics are frozen, the cost of a byte depends only on it and the
``ORDER`` bytes before it, so a worker computes each distinct gram once and
keeps its cost vector in a table of fixed size (``SLOTS``); another gram in
the same slot replaces it.

Training takes a bounded sample: about ``TRAIN_DOCS`` whole documents of each
language, chosen by a hash of the id. The model (one row per gram and
language) is bounded by that sample, not by the corpus.

``score`` is the probability of the winner, from the code lengths, evenly
weighted languages and ``TEMPER`` of the evidence (neighbouring bytes are not
independent). Texts that are NULL or hold no letter get ``und`` and score 0, as
do all texts if nothing could be learned. Rows are scored one by one; repeated
ids and rows give repeated results. An input column named like an output is
replaced.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .arrow import only, ship_package, slices, with_columns

ORDER = 3
TRAIN_DOCS = 1_500   # documents of a language used for training, about
HASH_RANGE = 1 << 20
TEMPER = 0.1
SLOTS_LOG2 = 19
PIECE = 1 << 20      # bytes scored at once
START = 0x0A         # a text reads as if it came after line breaks
UNDETERMINED = "und"

LETTER = regex.compile(r"\p{L}")


def grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The byte at each position with the ``ORDER`` bytes before it, packed.

    ``data`` holds the texts one after another; nothing before a text's start
    is looked at.
    """
    wide = data.astype(np.uint32)
    out = wide.copy()
    for back in range(1, ORDER + 1):
        before = np.full(len(wide), START, np.uint32)
        before[back:] = wide[:-back]
        for ahead in range(back):  # the text's first bytes have no such context
            at = starts + ahead
            before[at[at < len(wide)]] = START
        out |= before << np.uint32(8 * back)
    return out


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its texts."""
    column = column.cast(pa.binary()).fill_null(b"")
    joined = column.to_pylist()
    ends = np.zeros(len(joined) + 1, np.int64)
    np.cumsum([len(t) for t in joined], out=ends[1:])
    return np.frombuffer(b"".join(joined), np.uint8), ends


def _fix_short(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return starts[ends > starts]


def gram_counts(labelled: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Counts (lang, gram, n) over whole texts, combined inside each task."""
    ship_package(labelled)
    schema = StructType([StructField("lang", StringType()), StructField("gram", LongType()),
                         StructField("n", LongType())])

    def count(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            names = batch.column("lang").to_pylist()
            for name in sorted(set(names)):
                rows = [i for i, x in enumerate(names) if x == name]
                data, ends = _bytes(batch.column("text").take(pa.array(rows)))
                if not len(data):
                    continue
                values, n = np.unique(grams(data, _fix_short(ends[:-1], ends[1:])), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": [name] * len(values), "gram": values.astype(np.int64), "n": n.astype(np.int64)})

    source = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return source.mapInArrow(count, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_sample(labelled: DataFrame, id: str = "doc_id", lang: str = "lang",
                    per_lang: int = TRAIN_DOCS) -> DataFrame:
    """About ``per_lang`` rows of each language, chosen by a hash of the id."""
    sizes = labelled.groupBy(lang).count().collect()  # one row per language
    share = F.lit(0)
    for row in sizes:
        part = min(HASH_RANGE, -(-per_lang * HASH_RANGE // row["count"]))
        share = F.when(F.col(lang) == row[lang], F.lit(part)).otherwise(share)
    place = F.pmod(F.xxhash64(F.col(id).cast("string"), F.lit(6)), F.lit(HASH_RANGE))
    return labelled.where(place < share)


class ContextTrees:
    """Frozen statistics of all languages, as sorted arrays per order."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        self.trees = []
        by_lang: dict[str, list[tuple[int, int]]] = {lang: [] for lang in self.langs}
        for lang, gram, n in rows:
            by_lang[lang].append((gram, n))
        for lang in self.langs:
            table = np.array(sorted(by_lang[lang]), np.int64).reshape(-1, 2)
            orders = []
            for order in range(ORDER + 1):
                key = table[:, 0] & ((1 << 8 * (order + 1)) - 1)
                keys, where = np.unique(key, return_inverse=True)
                counts = np.bincount(where, weights=table[:, 1]).astype(np.float64)
                contexts, where = np.unique(keys >> 8, return_inverse=True)
                total = np.bincount(where, weights=counts)
                kinds = np.bincount(where).astype(np.float64)
                orders.append((keys, counts, contexts, total, kinds))
            self.trees.append(orders)

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code lengths of grams: one row each, one column per language."""
        out = np.empty((len(gram), len(self.langs)))
        whole = gram.astype(np.int64)
        for column, orders in enumerate(self.trees):
            cost, todo = np.zeros(len(whole)), np.ones(len(whole), bool)
            for order in range(ORDER, -1, -1):
                keys, counts, contexts, total, kinds = orders[order]
                key = whole & ((1 << 8 * (order + 1)) - 1)
                c = np.minimum(np.searchsorted(contexts, key >> 8), len(contexts) - 1)
                known = todo & (contexts[c] == key >> 8)
                k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = known & (keys[k] == key)
                weight = total[c] + kinds[c]
                cost[hit] -= np.log2(counts[k] / weight)[hit]
                escape = known & ~hit
                cost[escape] -= np.log2(kinds[c] / weight)[escape]
                todo &= ~hit
            cost[todo] += 8.0
            out[:, column] = cost
        return out


class Scorer:
    """Code lengths of texts, with a table of gram costs of fixed size."""

    def __init__(self, trees: ContextTrees):
        self.trees = trees
        self.keys = np.full(1 << SLOTS_LOG2, -1, np.int64)
        self.costs = np.zeros((1 << SLOTS_LOG2, max(1, len(trees.langs))), np.float32)

    def slots(self, gram: np.ndarray) -> np.ndarray:
        return (gram * np.uint32(2654435761)) >> np.uint32(32 - SLOTS_LOG2)

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Bits of each text under each language."""
        data, ends = _bytes(column)
        sums = np.zeros((len(ends) - 1, len(self.trees.langs)))
        rows = np.flatnonzero(ends[1:] > ends[:-1])
        starts = ends[rows]
        for a in range(0, len(data), PIECE):  # bounded memory for very long texts
            b, back = min(len(data), a + PIECE), max(0, a - ORDER)
            inside = starts[(starts >= back) & (starts < b)]
            cost = self.costs_of(grams(data[back:b], inside - back)[a - back:])
            cuts = np.append(0, inside[inside > a] - a)
            first = np.searchsorted(starts, a, "right") - 1
            sums[rows[first:first + len(cuts)]] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)
        return sums

    def costs_of(self, gram: np.ndarray) -> np.ndarray:
        """Bits of each gram under each language, from the table where it can."""
        slot = self.slots(gram)
        missed = np.flatnonzero(self.keys[slot] != gram)
        exact = None
        if len(missed):
            new = np.unique(gram[missed])
            bits = self.trees.bits(new).astype(np.float32)
            self.keys[self.slots(new)] = new
            self.costs[self.slots(new)] = bits
            missed = np.flatnonzero(self.keys[slot] != gram)  # grams that share a slot
            if len(missed):
                new = np.unique(gram[missed])
                exact = self.trees.bits(new).astype(np.float32)[np.searchsorted(new, gram[missed])]
        cost = self.costs[slot]
        if exact is not None:
            cost[missed] = exact
        return cost


_WORKER: dict[str, Scorer] = {}


def identify(docs: DataFrame, labelled: DataFrame, id: str = "doc_id", text: str = "text",
             lang: str = "lang", label_id: str = "doc_id", per_lang: int = TRAIN_DOCS,
             drop: tuple[str, ...] = (), bits: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learned from the rows of
    ``labelled`` (``label_id``, ``text``, ``lang``; rows without a language or
    text are left out). With ``bits``, a column of that name holds the text's
    code length under the predicted language (NULL where there is none): the
    score only tells the languages apart, the length tells whether the text is
    in any of them."""
    rows = only(labelled, label_id, text, lang).where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sample = training_sample(rows, label_id, lang, per_lang)
    model = [(r.lang, r.gram, r.n) for r in gram_counts(sample, lang, text).toLocalIterator()]
    trees = docs.sparkSession.sparkContext.broadcast(ContextTrees(model))  # bounded by the sample
    key = uuid.uuid4().hex  # names this model in a worker

    def factory():
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Scorer(trees.value)
        scorer = _WORKER[key]
        langs = scorer.trees.langs

        def work(batch):
            column = batch.column(text)
            if not langs:
                return [[UNDETERMINED] * len(column), [0.0] * len(column)] + [[None] * len(column)] * (bits is not None)
            lengths = scorer.code_lengths(column)
            best = lengths.argmin(axis=1)
            least = lengths.min(axis=1)
            behind = (lengths - least[:, None]) * TEMPER
            sure = 1.0 / np.exp2(-np.minimum(behind, 1000.0)).sum(axis=1)
            letters = [t is not None and LETTER.search(t) is not None for t in column.to_pylist()]
            out = [[langs[b] if ok else UNDETERMINED for b, ok in zip(best, letters)],
                   [float(s) if ok else 0.0 for s, ok in zip(sure, letters)]]
            return out + [[float(n) if ok else None for n, ok in zip(least, letters)]] * (bits is not None)

        return work

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if bits is not None:
        fields.append(StructField(bits, DoubleType()))
    return with_columns(docs, factory, fields, drop=drop)
