"""Document fingerprints: a homomorphic multiset hash (operator 1).

A text is a multiset of paragraph pieces: lines, cut after sentence ends and,
where a sentence is longer, after every ``PIECE_WORDS`` words. Each piece is
hashed to a wide vector of ``LANES`` bits, and a text's fingerprint is the
vector sum over its pieces, with the number of pieces. Three lanes of
``LANE_BITS`` bits share one long and are added modulo 2^60.

* **Equality**: equal multisets have equal fingerprints whatever their order;
  different ones collide only if all lanes agree.
* **Increments**: ``plus`` and ``minus`` insert and delete the pieces of
  another fingerprint without reading the text again.
* **Likeness**: centred, the lanes are sums of random signs, so the mean square
  of the lanes' difference estimates how many pieces differ. ``likeness`` is
  1 - differing / (all pieces, both sides): 1 for equal fingerprints, about the
  common share of pieces otherwise, 0 at least.

White space around pieces does not count. NULL reads as the empty text: no
pieces, all lanes 0; two empty fingerprints have likeness 1. A lane holds up to
2^20 pieces, beyond that neighbouring lanes mix: sums stay equal for equal
texts, likeness loses meaning. Everything is built-in column functions; each
text is handled in its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import following

PIECE_WORDS = 8
LANE_BITS = 20
HASHES = 2                             # 64-bit hashes of a piece
LANES = HASHES * LANE_BITS * 3         # 60 bits of each are used
_ONES = 1 | 1 << LANE_BITS | 1 << 2 * LANE_BITS
_ALL = (1 << 3 * LANE_BITS) - 1

#: Up to PIECE_WORDS words of a line; a word that ends a sentence ends the piece.
PIECE = r"(?:\S*[^\s.!?][ \t]+){0,%d}\S+" % (PIECE_WORDS - 1)


def pieces(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), F.array().cast("array<string>"))


def _add(a: F.Column, b: F.Column) -> F.Column:
    return (a + b).bitwiseAND(F.lit(_ALL))


def _hashes(seed: int) -> F.Column:
    return F.transform("_pieces", lambda p: F.xxhash64(p, F.lit(seed)))


def _lane_sum(hashes: str, shift: int) -> F.Column:
    """Three packed lanes: bits of all hashes, summed."""
    bits = lambda h: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_ONES))
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: _add(acc, bits(h)))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint ``name`` (array of long: the number of pieces,
    then the packed lanes) of the string column ``text``."""
    hashed = df.withColumn("_pieces", pieces(F.col(text)))
    hashed = hashed.select("*", *[_hashes(seed).alias(f"_h{seed}") for seed in range(HASHES)])
    lanes = [_lane_sum(f"_h{seed}", shift) for seed in range(HASHES) for shift in range(LANE_BITS)]
    return (hashed.withColumn(name, F.array(F.size("_pieces").cast("long"), *lanes))
            .drop("_pieces", *[f"_h{k}" for k in range(HASHES)]))


def plus(a: F.Column, b: F.Column) -> F.Column:
    """The fingerprint of both multisets together."""
    return F.zip_with(a, b, _add)


def minus(a: F.Column, b: F.Column) -> F.Column:
    """The fingerprint of ``a`` without the pieces of ``b``, which it holds."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_ALL)))


def text_form(fp: F.Column) -> F.Column:
    """15 hex digits for the count and for each three lanes."""
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 15, "0")), "")


def _signed_lanes(fp: F.Column) -> F.Column:
    """Centred lanes: 2 * lane - pieces, a sum of random signs."""
    packed = F.slice(fp, 2, HASHES * LANE_BITS)
    lane = lambda x, i: F.shiftright(x, i * LANE_BITS).bitwiseAND(F.lit((1 << LANE_BITS) - 1)) * 2 - fp[0]
    return F.flatten(F.transform(packed, lambda x: F.array(*[lane(x, i) for i in range(3)])))


def likeness(a: str, b: str) -> F.Column:
    """Likeness (0 to 1) of two columns of centred lanes (``_signed_lanes``)."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    square = lambda c: F.transform(c, lambda x: (x * x).cast("double"))
    apart = total(F.zip_with(a, b, lambda x, y: ((x - y) * (x - y)).cast("double")))
    both = total(square(a)) + total(square(b))
    return F.when(apart == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - apart / both))


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit, in which the last quarter of
    its code points is replaced by as many first ones of the next document.

    The next document is that of the next greater id, of the smallest one after
    the greatest; NULL is the smallest id. Where an id repeats, every row of it
    has the same next document, and the row with the least head stands for it.

    Ids are ordered on their own; texts move once to their id, and a quarter of
    them, the heads, again to the id before. Both sides of the joins are
    shuffled for the join alone, so Spark can split an id with very many rows.

    Returns ``id``, ``text`` (NULL as empty), ``edited``, ``fp``, ``edited_fp``,
    ``next_fp``.
    """
    base = with_fingerprint(docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")),
                            "text", "fp")
    ids = (docs.select(F.col(id).alias("id"), F.coalesce(F.char_length(text), F.lit(0)).alias("n"))
           .groupBy("id").agg(F.max("n").alias("n"), F.count("*").alias("rows")))
    after = following(ids, "id", "next", ("rows",)).select(
        F.col("next.id").alias("key"), F.col("next.rows").alias("rows"),
        F.col("id").alias("before"), F.floor(F.col("n") / 4).cast("int").alias("length"))
    heads = base.join(after, F.col("id").eqNullSafe(F.col("key"))).select(
        "before", "rows", F.substring("text", F.lit(1), F.col("length")).alias("head"), F.col("fp").alias("next_fp"))
    single = heads.where("rows = 1").select("before", "head", "next_fp")
    least = (heads.where("rows > 1").groupBy("before").agg(F.min(F.struct("head", "next_fp")).alias("x"))
             .select("before", "x.head", "x.next_fp"))
    joined = base.join(single.union(least), F.col("id").eqNullSafe(F.col("before")))
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = joined.select("id", "text", "fp", "next_fp", F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - quarter),
        F.substring("head", F.lit(1), quarter)).alias("edited"))
    return with_fingerprint(edited, "edited", "edited_fp").withColumnRenamed("id", id)


def compared(df: DataFrame) -> DataFrame:
    """``df`` (from ``edited_fingerprints``) with ``near_edited``, ``near_next``."""
    names = ("fp", "edited_fp", "next_fp")
    lanes = df.select("*", *[_signed_lanes(F.col(c)).alias(f"_{c}") for c in names])
    return lanes.select("*", likeness("_fp", "_edited_fp").alias("near_edited"),
                        likeness("_fp", "_next_fp").alias("near_next")).drop(*[f"_{c}" for c in names])
