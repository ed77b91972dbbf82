"""BPE encoding and decoding on a contiguous rank array (operator 10).

A word's parts lie side by side in one array, and a second array holds the
merge rank of each pair of neighbours. Encoding scans the ranks for the
leftmost minimum, deletes the boundary there, and refreshes the two ranks next
to it, until no pair can merge. Words of more than ``SHORT`` parts keep the
same order of merges with a heap, so that a text without spaces stays cheap.

The merge rules, ids and special tokens come from the tokenizer file; the
library is only asked to normalize and split texts with characters outside
``words.PLAIN``. NULL reads as the empty text, which has no ids and decodes to
the empty text. Rows are encoded one by one: repeated rows give repeated rows.
An input column named like an output is replaced.
"""

from __future__ import annotations

import heapq
import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from . import words as W
from .arrow import texts, with_columns

SHORT = 128      # parts up to which the ranks are scanned
CACHE = 120_000  # runs of a generation that a worker keeps, and half as many words
LONGEST = 48     # characters of a run or word that is kept
NONE = 1 << 30   # rank of a pair without a rule
SHIFT = 24       # bits of an id in the key of a pair


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class WordBpe:
    """A byte-level BPE with an end-of-word mark, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = W.specials(path)
        self.names = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for name, i in [*self.ids.items(), *self.special.items()]:
            self.names[i] = name
        letters = W.byte_alphabet()
        self.first = [self.ids[c] for c in letters]
        self.last = [self.ids[c + end] for c in letters]
        self.ranks: dict[int, int] = {}  # key: left id << SHIFT | right id
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.ids[a] << SHIFT | self.ids[b]] = rank
            self.merged.append(self.ids[a + b])
        self.pieces = W.splitter(self.special)
        self.split = regex.compile(W.WORD_SPLIT).findall
        self._library = None
        self._path = path
        # ids are kept packed, four bytes each: compact, and quick to join
        self.word_ids = W.Recent(lambda word: _pack(self.merge(word)), CACHE // 2, LONGEST)
        self.run_ids = W.Recent(self.encode_run, CACHE, LONGEST)

    def encode_run(self, run: str) -> bytes:
        """Packed ids of a text of ``words.PLAIN`` characters without white space."""
        words = self.split(W.normalize_word(run))
        if len(words) == 1:
            return self.word_ids[words[0]]
        return b"".join([self.word_ids[word] for word in words])

    def library_words(self, piece: str) -> list[str]:
        """Normalized words of any text without special tokens."""
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self._path)
        text = self._library.normalizer.normalize_str(piece)
        back = {c: b for b, c in enumerate(W.byte_alphabet())}
        return [bytes(back[c] for c in mapped).decode("utf-8")
                for mapped, _ in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        raw = word.encode("utf-8")
        parts = [self.first[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank_of, merged = self.ranks.get, self.merged
        ranks = [rank_of(a << SHIFT | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != NONE:
            at = ranks.index(low)
            parts[at] = new = merged[low]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << SHIFT | new, NONE)
            if at < len(ranks):
                ranks[at] = rank_of(new << SHIFT | parts[at + 1], NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        todo: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.ranks.get(parts[i] << SHIFT | parts[j])) is not None:
                heapq.heappush(todo, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while todo:
            rank, i, a, b = heapq.heappop(todo)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        out: list[bytes] = []
        for piece in self.pieces(text):
            if piece in self.special:
                out.append(_pack([self.special[piece]]))
            elif W.PLAIN.fullmatch(piece):
                out += map(self.run_ids.__getitem__, piece.split())
            else:
                out += map(self.word_ids.__getitem__, self.library_words(piece))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space: the file names no decoder, and special
        tokens are kept. Ids outside the vocabulary are skipped."""
        names, n = self.names, len(self.names)
        return " ".join([names[i] for i in ids if 0 <= i < n])


_WORKER: dict[str, WordBpe] = {}


def worker_bpe(path: str) -> WordBpe:
    """The worker's encoder: loaded once, kept between tasks."""
    if path not in _WORKER:
        _WORKER[path] = WordBpe(path)
    return _WORKER[path]


def encode(docs: DataFrame, path: str, text: str = "text", drop: tuple[str, ...] = (),
           decoded: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (array of int) of ``text``; with
    ``decoded`` also what ``decode`` makes of the ids, in the same pass."""

    def factory():
        bpe = worker_bpe(path)

        def work(batch):
            rows = [bpe.encode(t) for t in texts(batch, text)]
            sizes = [len(r) for r in rows]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()),
                                           pa.array(np.concatenate(rows)))
            return [sizes, ids] + [[bpe.decode(r.tolist()) for r in rows]] * decoded

        return work

    fields = [StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType()))]
    return with_columns(docs, factory, fields + [StructField("decoded", StringType())] * decoded, drop=drop)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its id lists (NULL list: empty)."""

    def factory():
        bpe = worker_bpe(path)

        def work(batch):
            column = batch.column(ids)
            return [[bpe.decode(row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else [])
                     for row in column]]

        return work

    return with_columns(encoded, factory, [StructField("decoded", StringType())])
