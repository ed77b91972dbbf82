"""Token counts by a two-tier, map-side lookup (operator 3).

A text is split into pre-tokens; the number of tokens of a pre-token is the
same wherever it stands, so a text's count is a sum of lookups:

1. a broadcast hash table of frequent pre-tokens and their lengths, and
2. the worker's own bounded cache, filled by encoding what the table misses.

No pre-token is ever shuffled. The table holds at most ``FREQUENT`` entries
and the cache at most ``CACHE`` (entries longer than ``LONGEST`` characters
are never kept), whatever the input. The table only decides where a length is
found, never what it is, so it is taken from a bounded sample of rows.

NULL and empty texts have no tokens. Repeated rows and ids are counted row by
row. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, StringType

from . import words as W
from .arrow import only, ship_package, texts, with_columns

SAMPLE_ROWS = 2_000
FREQUENT = 1 << 15
CACHE = 400_000
LONGEST = 64


class Lengths(dict):
    """Token counts of pre-tokens: the broadcast table, then what was missed."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer
        super().__init__(frequent)
        self.frequent, self.tokenizer = frequent, Tokenizer.from_file(path)

    def __missing__(self, word: str) -> int:
        n = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= LONGEST:
            if len(self) >= CACHE + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n


class Counting:
    """Counts tokens of texts; one per worker and tokenizer file."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.lengths = Lengths(path, frequent)
        special = W.specials(path)
        self.special = frozenset(special)
        self.pieces = W.splitter(special)
        self.split = regex.compile(W.BYTE_LEVEL_SPLIT).findall
        self.library = self.lengths.tokenizer.pre_tokenizer

    def pre_tokens(self, piece: str) -> list[str]:
        if W.PLAIN.fullmatch(piece):
            return self.split(piece)
        return [piece[a:b] for _, (a, b) in self.library.pre_tokenize_str(piece)]

    def count(self, text: str) -> int:
        total, length = 0, self.lengths.__getitem__
        for piece in self.pieces(text):
            total += 1 if piece in self.special else sum(map(length, self.pre_tokens(piece)))
        return total


_WORKER: dict[tuple[str, str], Counting] = {}


def _counting(path: str, frequent: dict[str, int], key: str) -> Counting:
    """The worker's counter: kept between tasks, one at a time."""
    if (path, key) not in _WORKER:
        _WORKER.clear()
        _WORKER[path, key] = Counting(path, frequent)
    return _WORKER[path, key]


def frequent_lengths(docs: DataFrame, path: str, text: str = "text",
                     sample_rows: int = SAMPLE_ROWS, entries: int = FREQUENT) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of about ``sample_rows`` rows."""
    ship_package(docs)

    def top(batches):
        import pyarrow as pa
        counting, seen = Counting(path, {}), Counter()
        for batch in batches:
            for t in texts(batch):
                for piece in counting.pieces(t):
                    if piece not in counting.special:
                        seen.update(w for w in counting.pre_tokens(piece) if len(w) <= LONGEST)
                if len(seen) > 8 * entries:  # bounded memory: keep the heavier half
                    seen = Counter(dict(seen.most_common(4 * entries)))
        best = [w for w, _ in seen.most_common(entries)]
        yield pa.RecordBatch.from_pydict({"w": best, "n": [counting.lengths[w] for w in best]})

    part = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(F.col(text).alias("text")).sample(part, seed=3).repartition(1)  # about sample_rows rows
    rows = sample.mapInArrow(top, StructType([StructField("w", StringType()),
                                              StructField("n", LongType())])).collect()
    return {r.w: r.n for r in rows[:entries]}


def count_tokens(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text",
                 limit: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes``, ``n_tokens`` and, with
    ``limit``, ``over_limit`` (more than ``limit`` tokens)."""
    source = only(docs, id, text).withColumnRenamed(text, "text")
    frequent = source.sparkSession.sparkContext.broadcast(frequent_lengths(source, path))
    key = uuid.uuid4().hex  # names this table in a worker

    def factory():
        counting = _counting(path, frequent.value, key)

        def work(batch):
            values = texts(batch)
            return [pc.fill_null(pc.binary_length(batch.column("text")), 0).cast("int64"),
                    [counting.count(t) for t in values]]

        return work

    out = with_columns(source, factory, [StructField("n_bytes", LongType()),
                                         StructField("n_tokens", LongType())], drop=["text"])
    return out if limit is None else out.withColumn("over_limit", F.col("n_tokens") > limit)


