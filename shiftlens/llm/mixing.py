"""Mixing sources to target weights by whole copies and one hash-seeded Bernoulli copy.

Words are counted per source; a source's repetition rate is its target over its size, and each
document is emitted floor(rate) times plus once more with the probability of the fraction, decided
by a hash of seed and doc_id, so that reruns agree.

Edge cases: a null or empty text has size 0; a null source is a source of its own, last in order;
a source of size 0 has target 0 and rate 0; repeated rows of one doc_id get the same decision; an
empty table gives an empty mix; other columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import checked, numbered, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST, SEED = 1.5, 2, "mix"


def words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: source, n (rows), source_size, target, rate.

    Targets share ``share`` of all words by weight; a target above ``most`` times its source's size
    is cut to that and the excess reshared by weight until none is above.  A round is one
    aggregation over the staged sources; the driver sees only the level, words per unit of weight.
    """
    size = docs.select(F.col("source"), words().alias("size")).groupBy("source")
    sized = staged(size.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), "sources")
    place = F.col("_n") % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int"))
    ranked = staged(numbered(sized, F.col("source").asc_nulls_last()).withColumn("weight", weight.cast("long")), "weights")
    most_words = F.col("source_size") * most
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > most_words
        row = ranked.agg(
            F.sum(F.when(over, most_words).otherwise(0)).alias("cut"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(over, 1)).alias("above"),
        ).first()
        if row["above"] == above or not row["open"]:
            break
        above, level = row["above"], (share * total - row["cut"]) / row["open"]
    target = F.least(most_words.cast("double"), F.col("weight") * F.lit(level))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return ranked.withColumn("target", target).select("source", "n", "source_size", "target", rate.alias("rate"))


def coin(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the md5 of seed and doc_id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(docs: DataFrame, rates: DataFrame, seed: str = SEED) -> DataFrame:
    """row (all columns of ``docs``), source_size, target, copies."""
    rows = docs.select(F.struct("*").alias("row"))
    facts = rates.select(F.struct("source", "source_size", "target", "rate").alias("s"))
    # one row per source: broadcast while they are few; past that AQE splits the partitions of a hot source
    found = rows.join(checked(facts), F.col("row.source").eqNullSafe(F.col("s.source")), "left")
    rate = F.coalesce(F.col("s.rate"), F.lit(0.0))
    copies = F.floor(rate) + F.when(coin(F.col("row.doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return found.select("row", "s.source_size", "s.target", copies.cast("int").alias("copies"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixture: every row of ``docs`` as often as its source's rate says."""
    planned = plan(docs, sources(docs, weights, share, most), seed).filter(F.col("copies") > 0)
    return planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "source", "text")
    planned = plan(rows, sources(rows)).withColumn("size", words("row.text"))
    return planned.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k FROM s
), c AS (
  SELECT *, (1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), l AS (
  SELECT level FROM c WHERE level * weight <= 2 * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least(2.0 * source_size, weight * (SELECT level FROM l))::DOUBLE AS target FROM s
), r AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 AS coin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken,
       (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER AS copies
FROM r
"""
