"""Alignment of two tokenizers' tokens over the same bytes (operator 13).

A text is encoded by a byte-level BPE of the tokenizers library (A, of a space
and the text) and by a sentencepiece model (B, which adds that space itself).
Both lists of tokens cut the same bytes; two tokens are *linked* where their
byte ranges overlap, and the offsets where both cut divide them into *groups*.

**Cuts.** The libraries' own spans are the coarse cuts: A's are offsets of
characters, B's are byte spans. Where several tokens share a
character (A cuts a multibyte character, B falls back to bytes) the spans say
only where that character lies, and the tokens' decoded bytes refine it.

**Chunks.** No pre-token of A and no piece of B reaches over a single space
between two characters that are not white space, nor over the place before a
single line feed between such characters (``Aligner`` checks B's pieces for
that), so a text is aligned chunk by chunk between such places. A worker keeps
the alignments of recent chunks in a bounded cache, and encodes what a batch of
rows misses in runs of bounded size, as the libraries' results take far more
memory than the texts.

**Counts.** A pair's count is the number of documents that hold it linked.
Counts are summed by Spark from one row per document and pair. The most
frequent pairs (``FREQUENT`` at most, by a histogram of 64 powers of two) are
broadcast and looked up inside the tasks; the others meet their counts in a
shuffled join, in which no key has more rows than the frequent pairs' least
count. Nothing is dropped.

A text that is NULL or empty, or whose tokens' bytes do not join to the space
and the text (B reads U+2581 as a space), has no tokens: its counts are zero and
its groups empty. A very long text is one row, aligned chunk by chunk. Repeated
rows are documents of their own, NULL ids too; columns other than the id and
the text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from . import words as W
from .arrow import only, texts, with_columns
from .shared import stored

CACHE = 300_000     # chunks of a generation that a worker keeps
LONGEST = 48        # characters of a chunk that is kept
RUN = 1 << 17       # characters of chunks that the libraries encode at once
ROWS = 128          # rows whose chunks a worker holds at once
FREQUENT = 1 << 19  # pairs whose counts are broadcast, at most
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
BESIDE = re.compile(r"\s\s")
SPACE = "▁"         # fixed value: sentencepiece's mark of a space

#: A chunk's alignment: the numbers of A tokens, B tokens, groups and links, the
#: groups as text, and the linked pairs packed into numbers; None: bytes differ.
Chunk = tuple[int, int, int, int, str, bytes]


class Aligner:
    """Aligns the tokens of two tokenizer files; one per worker.

    A chunk is named by its text without the space before it; one that begins
    with a line feed has no space before it.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.size_b = size
        # a packed pair takes four bytes where the vocabularies allow it
        self.packed = np.uint32 if self.a.get_vocab_size() * size <= 1 << 32 else np.int64
        self.bytes_a = {c: b for b, c in enumerate(W.byte_alphabet())}
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.is_byte = {i for i in range(size) if self.b.is_byte(i)}
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if i in self.is_byte else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        # pieces with a space behind other characters, or a line feed, could join two chunks
        self.whole = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces)
        # ids as text, with the mark that can follow each
        self.names = {mark: np.array([f"{i}{mark}" for i in range(max(size, self.a.get_vocab_size()))], object) for mark in ",|;\n"}
        self.young: dict[str, Chunk | None] = {}
        self.old: dict[str, Chunk | None] = {}

    def cuts_a(self, text: str, found) -> list[int]:
        """The byte offsets of ``text`` where A's tokens end."""
        spans = found.offsets
        if text.isascii():
            return [end for _, end in spans]
        at, ends, here = _byte_offsets(text), [], 0
        for i, ((_, end), token) in enumerate(zip(spans, found.tokens)):
            shared = i + 1 < len(spans) and spans[i + 1][0] < end  # the next token has a part of this character
            here = here + len(token) if shared else at[end]        # a letter of a token stands for a byte
            ends.append(here)
        return ends

    def cuts_b(self, found, added: int) -> tuple[list[int], list[int]]:
        """Ids of B's tokens, and the byte offsets where they end, counting
        ``added`` bytes of a space before the text."""
        ids, spans = found["ids"], found["offsets"]
        if self.is_byte.isdisjoint(ids):
            return ids, [end + added for _, end in spans]
        ends, here = [], 0
        for i, (_, end) in zip(ids, spans):
            here = here + 1 if i in self.is_byte else end + added
            ends.append(here)
        return ids, ends

    def chunks(self, texts: list[str], spaces: list[bool]) -> list[Chunk | None]:
        """Alignments of chunks, given whether a space stands before each; all are
        laid end to end and their cuts compared at once."""
        led = [" " + t if s else t for t, s in zip(texts, spaces)]
        of_a = self.a.encode_batch(led, add_special_tokens=False)
        of_b = self.b.encode(texts, return_type="offset_mapping", return_bytes=True) if texts else []
        a, ends_a, b, ends_b, lengths, bytes_b = [], [], [], [], [], self.bytes_b
        for text, space, found_a, found_b in zip(led, spaces, of_a, of_b):
            cuts_a = self.cuts_a(text, found_a)
            ids_b, cuts_b = self.cuts_b(found_b, int(space))
            if not space:  # B's own space is no part of this chunk
                del ids_b[0], cuts_b[0]
            raw = text.encode()
            if cuts_a[-1] != len(raw) or b"".join([bytes_b[i] for i in ids_b]) != raw:
                lengths.append((0, 0, 0))
                continue
            a += found_a.ids
            b += ids_b
            ends_a += cuts_a
            ends_b += cuts_b
            lengths.append((len(raw), len(cuts_a), len(cuts_b)))
        size, n_a, n_b = np.array(lengths, np.int64).reshape(-1, 3).T
        ends = np.cumsum(size)  # of the chunks
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a = np.array(ends_a, np.int64) + np.repeat(ends - size, n_a)
        ends_b = np.array(ends_b, np.int64) + np.repeat(ends - size, n_b)
        cuts, both = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        # a link ends at each cut, a group at each that both make
        pairs = a[np.searchsorted(ends_a, cuts)] * self.size_b + b[np.searchsorted(ends_b, cuts)]
        n_links, n_groups = (np.diff(np.searchsorted(x, np.append(0, ends), "right")) for x in (cuts, both))
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        named_a, named_b = self.names[","][a], self.names[","][b]
        if len(a):
            last_a, last_b = both[group_a] == ends_a, both[group_b] == ends_b
            named_a[last_a], named_b[last_b] = self.names["|"][a[last_a]], self.names[";"][b[last_b]]
            final = np.searchsorted(ends_b, ends[size > 0])  # the last token of each chunk
            named_b[final] = self.names["\n"][b[final]]
        # the tokens of A of a group stand before those of B: each behind what came before it
        named = np.empty(len(a) + len(b), object)
        named[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = named_a
        named[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = named_b
        groups = iter("".join(named.tolist()).split("\n"))
        packed, width = pairs.astype(self.packed).tobytes(), np.dtype(self.packed).itemsize
        at = np.cumsum(n_links) * width
        return [(x, y, g, n, next(groups), packed[e - width * n:e]) if x else None
                for x, y, g, n, e in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), at.tolist())]

    def split(self, text: str) -> list[str]:
        """The names of a text's chunks. The first may begin with white space and
        the last end with it; where others would, the text is cut with care."""
        if self.whole:
            return [text]
        names = text.replace("\n", " \n").split(" ")
        if "" not in names and not BESIDE.search(text):
            return names
        first, *rest = CUT.split(" " + text)
        return [first[1:], *[c if c[0] == "\n" else c[1:] for c in rest]]

    def align(self, rows: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray]]:
        """Per text: numbers of A tokens, B tokens, groups and links, the groups
        as text, and the packed pair of every link."""
        with _uncollected():
            return self._align([self.split(t) if t else [] for t in rows])

    def _align(self, split: list[list[str]]) -> list[tuple[int, int, int, int, str, np.ndarray]]:
        wanted, young, old = set().union(*split), self.young, self.old
        held = {n: young[n] for n in wanted & young.keys()}
        wanted.difference_update(held)
        fresh = {n: old[n] for n in wanted & old.keys()}
        for run in runs(wanted.difference(fresh)):
            fresh.update(zip(run, self.chunks(run, [n[0] != "\n" for n in run])))
        # a space stands before a text's first chunk, whatever it begins with
        firsts = [names[0] for names in split if names and names[0][0] == "\n"]
        heads = (c for run in runs(firsts) for c in self.chunks(run, [True] * len(run)))
        self._keep(fresh)
        held.update(fresh)
        out = []
        for names in split:
            found = [*map(held.__getitem__, names)]
            if names and names[0][0] == "\n":
                found[0] = next(heads)
            if found and None not in found:
                *counts, groups, pairs = zip(*found)
                out.append((*map(sum, counts), ";".join(groups), np.frombuffer(b"".join(pairs), self.packed)))
            else:
                out.append((0, 0, 0, 0, "", np.empty(0, self.packed)))
        return out

    def _keep(self, fresh: dict[str, Chunk | None]) -> None:
        """The batch's chunks that were not among the youngest join them; a full
        generation ages."""
        self.young.update({n: c for n, c in fresh.items() if len(n) <= LONGEST})
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young


@contextmanager
def _uncollected():
    """A batch without the collector of cycles: it makes none, and the searches
    through its many small tuples took an eighth of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def runs(names: Iterable[str]) -> Iterator[list[str]]:
    """The names in lists of about ``RUN`` characters (a longer name ends its
    list): what the libraries return of a chunk takes far more than its text."""
    run, size = [], 0
    for name in names:
        run.append(name)
        size += len(name)
        if size >= RUN:
            yield run
            run, size = [], 0
    if run:
        yield run


def _byte_offsets(text: str) -> list[int] | range:
    """Byte offset of each character, and of the end."""
    if text.isascii():
        return range(len(text) + 1)
    return list(accumulate(map(len, map(str.encode, text)), initial=0))


_WORKER: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core
    if (path_a, path_b) not in _WORKER:
        _WORKER.clear()
        _WORKER[path_a, path_b] = Aligner(path_a, path_b)
    return _WORKER[path_a, path_b]


def _release() -> None:
    """A worker that goes on to other work gives up its tokenizers and chunks."""
    _WORKER.clear()


def _lists(rows: list[np.ndarray], kind=np.int32) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat.astype(kind)))


def align(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``), and its different linked pairs as
    ``pair_a``, ``pair_b`` with how often each is linked, ``times``."""

    def factory():
        aligner = _aligner(path_a, path_b)

        def work(batch):
            found = aligner.align(texts(batch, text))
            pairs = [np.unique(f[5], return_counts=True) for f in found]
            return [*[[f[i] for f in found] for i in range(5)],
                    _lists([p // aligner.size_b for p, _ in pairs]), _lists([p % aligner.size_b for p, _ in pairs]),
                    _lists([n for _, n in pairs])]

        return work

    counts = [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    lists = [StructField(n, ArrayType(IntegerType())) for n in ("pair_a", "pair_b", "times")]
    return with_columns(only(docs, id, text), factory, [*counts, StructField("groups", StringType()), *lists], drop=(text,),
                        slice_rows=ROWS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` (documents that link the two ids) and ``best`` (no
    pair of that ``a`` has more)."""
    pairs = aligned.select(F.explode(F.arrays_zip("pair_a", "pair_b")).alias("p"))
    counts = stored(pairs.groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b")).agg(F.count("*").alias("n")))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most a row per id of A
    return counts.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, frequent: int) -> int:
    """The least power of two for which at most ``frequent`` pairs have as many
    documents or more."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(power.alias("power")).count().collect())  # at most 63 rows
    cut, taken = 63, 0
    while cut > 0 and taken + sizes.get(cut - 1, 0) <= frequent:
        cut -= 1
        taken += sizes.get(cut, 0)
    return 1 << cut if cut < 63 else (1 << 63) - 1


def scored(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` (a written table) with ``n_best`` and ``count_sum`` in place of
    its pairs: links whose count is their A id's highest, and all links' counts."""
    spark = aligned.sparkSession
    counts = pair_counts(aligned)
    cut = frequent_from(counts, frequent)
    table = counts.where(F.col("n") >= cut).toArrow()  # at most ``frequent`` rows
    a, b, n, best = (table.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n", "best"))
    key = a.astype(np.int64) << 32 | b
    order = np.argsort(key)
    held = spark.sparkContext.broadcast((key[order], n[order], best[order].astype(bool)))

    def factory():
        _release()
        keys, counts_, bests = held.value

        def work(batch):
            a, b, times = (batch.column(c) for c in ("pair_a", "pair_b", "times"))
            rows = np.repeat(np.arange(len(a)), pc.list_value_length(a).fill_null(0).to_numpy(zero_copy_only=False))
            a, b, times = (x.flatten().to_numpy(zero_copy_only=False) for x in (a, b, times))
            wanted = a.astype(np.int64) << 32 | b
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            known = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            linked = times[known].astype(np.int64)
            np.add.at(total, rows[known], linked * counts_[at[known]])
            np.add.at(top, rows[known], linked * bests[at[known]])
            rare = ~known
            first = pa.array(np.searchsorted(rows[rare], np.arange(batch.num_rows + 1)), pa.int32())
            return [pa.array(total), pa.array(top),
                    *[pa.ListArray.from_arrays(first, pa.array(x[rare].astype(np.int32))) for x in (a, b, times)]]

        return work

    found = [StructField("sum_known", LongType()), StructField("best_known", LongType())]
    rest = [StructField(x, ArrayType(IntegerType())) for x in ("rare_a", "rare_b", "rare_times")]
    numbered = aligned.withColumn("_row", F.monotonically_increasing_id())
    part = stored(with_columns(numbered, factory, [*found, *rest], drop=("pair_a", "pair_b", "times")))
    rare = part.select("_row", F.explode(F.arrays_zip("rare_a", "rare_b", "rare_times")).alias("p"))
    rare = rare.select("_row", F.col("p.rare_a").alias("a"), F.col("p.rare_b").alias("b"), F.col("p.rare_times").alias("times"))
    rare = rare.join(counts.where(F.col("n") < cut), ["a", "b"])
    rare = rare.groupBy("_row").agg(F.sum(F.col("times") * F.col("n")).alias("sum_rare"),
                                    F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rare"))
    add = lambda known, more: F.col(known) + F.coalesce(F.col(more), F.lit(0))
    out = part.join(rare, "_row", "left").withColumns({"n_best": add("best_known", "best_rare"),
                                                       "count_sum": add("sum_known", "sum_rare")})
    return out.drop("_row", "sum_known", "best_known", "rare_a", "rare_b", "rare_times", "sum_rare", "best_rare")
