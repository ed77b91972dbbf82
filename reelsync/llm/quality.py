"""Quality scores by Bradley-Terry pairwise ranking (operator 8).

A document's score is a weighted sum of text features. The weights come from
preference pairs: a document of label 1 is preferred to one of label 0 with
probability sigmoid(score difference), so the logistic loss is taken on the
difference of the two documents' features. Scores are then cut at a quantile
of the training scores, the share of label 0 among the training labels;
``score`` is sigmoid(s - cut), so it is 0.5 at the cut.

The fit uses a bounded sample: about ``PER_CLASS`` labelled documents of each
class chosen by a hash of the id, and ``PAIRS`` pairs among them. Whole texts
are read, in training and in scoring.

NULL reads as the empty text, which is scored like any other (all its shares
are 0). Labels that are neither 0 nor 1 are ignored. Without a pair to learn
from every document scores 0.5. A document labelled twice counts twice.
Repeated rows are scored one by one; an input column named like an output is
replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from .arrow import only, texts, with_columns

PER_CLASS = 6_000
PAIRS = 60_000
STEPS = 300
RIDGE = 1e-4
HASH_RANGE = 1 << 20

FEATURES = ("log_words", "short_words", "word_length", "distinct_words", "repeated_next",
            "capitals", "symbols", "exclamations", "digits", "stops", "repeated_lines",
            "odd_words", "compression")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "|$%&*#@^~_=+<>{}[]\\/"]] = True


def features(text: str) -> list[float]:
    """The features of one text, shares mostly; all 0 for the empty text."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    per_byte = np.bincount(raw, minlength=256)
    n, size = len(words), len(raw)
    different = set(words)
    odd = sum(1 for w in different if not w.strip(".,;:!?\"'()-").isalpha())
    lines = [x for x in text.split("\n") if x]
    return [
        float(np.log1p(n)),
        sum(1 for w in words if len(w) <= 3) / n,
        min(len(text) / n, 30.0) / 10,
        len(different) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(1 for w in words if w.isupper() and len(w) > 1) / n,
        float(per_byte[_SYMBOL].sum()) / size,
        float(per_byte[33]) / size,
        float(per_byte[48:58].sum()) / size,
        float(per_byte[46] + per_byte[44]) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        odd / len(different),
        len(zlib.compress(raw.tobytes(), 1)) / size if size < 1 << 20 else _compression(raw),
    ]


def _compression(raw: np.ndarray) -> float:
    """As one stream, a piece at a time: bounded memory for very long texts."""
    packer, size = zlib.compressobj(1), 0
    for at in range(0, len(raw), 1 << 20):
        size += len(packer.compress(raw[at:at + (1 << 20)].tobytes()))
    return (size + len(packer.flush())) / len(raw)


def text_features(docs: DataFrame, text: str = "text", name: str = "features",
                  drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the array ``name`` of its texts' ``FEATURES``."""

    def factory():
        return lambda batch: [[features(t) for t in texts(batch, text)]]

    return with_columns(docs, factory, [StructField(name, ArrayType(DoubleType()))], drop=drop)


def labelled_sample(labels: DataFrame, id: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` different labelled ids of each class, chosen by a hash."""
    rows = only(labels, id, label).where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).distinct()
    share = F.lit(0)
    for row in rows.groupBy(label).count().collect():  # two rows at most
        part = min(HASH_RANGE, -(-per_class * HASH_RANGE // row["count"]))
        share = F.when(F.col(label) == row[label], F.lit(part)).otherwise(share)
    place = F.pmod(F.xxhash64(F.col(id).cast("string"), F.lit(8)), F.lit(HASH_RANGE))
    return rows.where(place < share)


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, steps: int = STEPS) -> np.ndarray:
    """Weights that minimise the logistic loss on feature differences of random
    pairs (preferred, other), by gradient steps with momentum."""
    draw = np.random.default_rng(8)
    delta = good[draw.integers(len(good), size=pairs)] - bad[draw.integers(len(bad), size=pairs)]
    weights, speed = np.zeros(delta.shape[1]), np.zeros(delta.shape[1])
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(delta @ weights, -50, 50)))
        speed = 0.9 * speed + 0.1 * (delta.T @ lost / pairs - RIDGE * weights)
        weights = weights + speed
    return weights


class Ranking:
    """Weights on standardised features and the cut between the classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bad_share: float):
        self.mean, self.scale, self.weights, self.cut = 0.0, 1.0, None, 0.0
        if len(x) and 0 < y.sum() < len(y):
            self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
            z = (x - self.mean) / self.scale
            self.weights = fit_pairs(z[y == 1], z[y == 0])
            scores = z @ self.weights
            # the sample is balanced: weigh each class by its share of the labels
            weight = np.where(y == 1, (1 - bad_share) / (y == 1).sum(), bad_share / (y == 0).sum())
            order = np.argsort(scores, kind="stable")
            reach = np.cumsum(weight[order])
            at = min(int(np.searchsorted(reach, bad_share)), len(order) - 2)
            self.cut = float(scores[order][at:at + 2].mean())

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        s = np.clip((x - self.mean) / self.scale @ self.weights - self.cut, -50, 50)
        return 1 / (1 + np.exp(-s))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
        label: str = "quality", per_class: int = PER_CLASS) -> Ranking:
    """Learn from the labelled rows of ``labels`` (``id``, ``label``).

    The sampled ids are bounded by ``per_class`` and broadcast, so the
    documents are read in place and only the sample's features move: one row per
    id and label, the least features of an id with several documents, combined
    inside each task first. An id that holds a third of all rows is one row.
    """
    counts = {r[label]: r["count"] for r in only(labels, id, label)
              .where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    chosen = labelled_sample(labels, id, label, per_class).withColumnsRenamed({id: "_id", label: "_label"})
    rows = only(docs, id, text)
    joined = rows.join(F.broadcast(chosen), rows[id] == F.col("_id")).select("_id", "_label", F.col(text).alias("text"))
    found = text_features(joined, drop=("text",)).toDF("_id", "_label", "features")
    one = found.groupBy("_id", "_label").agg(F.min("features").alias("features"))
    # in the order of ids: the pairs drawn do not depend on the order of rows
    got = sorted(((r[0], r[1]), r[2]) for r in one.collect())
    got = [(label_, x) for (_, label_), x in got]
    x = np.array([f for _, f in got], float).reshape(-1, len(FEATURES))
    y = np.array([v for v, _ in got], int)
    return Ranking(x, y, counts.get(0, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, ranking: Ranking, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``score`` (0 to 1; at least 0.5 above the cut)."""

    def factory():
        def work(batch):
            x = np.array([features(t) for t in texts(batch, text)], float).reshape(-1, len(FEATURES))
            return [pa.array(ranking.score(x), pa.float64())]

        return work

    return with_columns(docs, factory, [StructField("score", DoubleType())], drop=drop)
