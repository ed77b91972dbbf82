"""Mixing sources to target weights (operator 2).

Every source gets a target: its share by weight of all sizes, but at most
``REPEAT`` times its own size; what it cannot take is shared again among the
others by weight, until none is above. Then a document of a source is emitted
floor(rate) times, rate = target / source size, plus one copy if a number
hashed from its id falls below the fraction, so reruns agree.

The targets come from the water level at which the fill ends: with sources in
order of (limit / weight), a source is full if its limit is not above its share
of what the fuller ones leave. Both sums run over the sorted sources in
ranges, so neither sources nor documents meet in one task; documents are
combined to one row per source before they move. The table of targets is
written, so Spark broadcasts it if it is small and shuffles otherwise.

A document's size is its number of words (NULL text: 0). Sources are ordered by
code point, NULL last (a source of its own), and weigh 1, 2, 3, repeating, or
by a given column expression. Documents of a source of size 0 are kept once.
Repeated ids draw the same number; a NULL id draws as the text "null".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import running, stored

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: a word
REPEAT = 3
SEED = "mix"


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source
    (``source``, ``source_size``)."""
    ranked = running(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], {"rank": F.lit(1)})
    weighted = ranked.select("_null", "source", "source_size", (F.col("rank") % 3 + 1).alias("weight"))
    exact = lambda c: F.col(c).cast("decimal(28,0)")  # noqa: E731  products of sums outgrow a long
    level = weighted.withColumn("level", F.col("source_size") * 6 / F.col("weight"))
    filled = running(level, ["level", "_null", "source"],
                     {"sizes": F.col("source_size"), "weights": F.col("weight")})
    # two rows of sums, as literals
    all_sizes, all_weights = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    full = filled.withColumn(
        "full", exact("source_size") * repeat * (F.lit(all_weights or 0) - F.col("weights")).cast("decimal(9,0)")
        <= F.col("weight") * (F.lit(all_sizes or 0).cast("decimal(28,0)") - repeat * exact("sizes")))
    full_sizes, full_weights = full.where("full").agg(F.sum("source_size"), F.sum("weight")).first()
    left, open_weights = (all_sizes or 0) - repeat * (full_sizes or 0), (all_weights or 0) - (full_weights or 0)
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(open_weights or 1))
    return full.select(
        "source", "source_size",
        F.when(F.col("full"), (F.col("source_size") * repeat).cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        repeat: int = REPEAT, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, how
    often the mix takes the document. Columns of these names are replaced."""
    plain = docs.drop("size", "source_size", "target", "copies").withColumn("size", word_count(text))
    sizes = plain.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    goal = stored(targets(sizes, repeat)).withColumnRenamed("source", "_mix_source")
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit("null")))),
                               1, 13), 16, 10).cast("double") / float(1 << 52)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    joined = plain.join(goal, F.col(source).eqNullSafe(F.col("_mix_source"))).drop("_mix_source")
    copies = F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")
    return joined.withColumn("copies", copies)


def emit(mixed: DataFrame) -> DataFrame:
    """Every row of ``mixed`` as often as ``copies`` says, without the columns
    that ``mix`` added."""
    return (mixed.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .drop("size", "source_size", "target", "copies"))


#: The rows of ``op2`` in DuckDB's SQL.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, coalesce(sum(s) OVER before, 0) AS s0, coalesce(sum(w) OVER before, 0) AS w0,
         sum(s) OVER () AS st, sum(w) OVER () AS wt
  FROM sources
  WINDOW before AS (ORDER BY s * 6 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, CAST(3 * s AS HUGEINT) * (wt - w0) <= w * (st - 3 * s0) AS is_full FROM filled),
goal AS (
  SELECT source, s AS source_size,
         CASE WHEN is_full THEN CAST(3 * s AS DOUBLE)
              ELSE CAST(w * (st - 3 * sum(CASE WHEN is_full THEN s ELSE 0 END) OVER ()) AS DOUBLE)
                   / CAST(wt - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER () AS DOUBLE) END AS target
  FROM judged),
rated AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 AS drawn
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
