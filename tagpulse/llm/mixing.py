"""Mixing sources to target weights.

Every document gets a hash-random key. Documents are range-sorted by (source, key), a distributed prefix sum
of sizes runs over that order, and each source is cut at its exact budget of words: whole epochs first, then
the documents before the cut, the one on the cut in part.

Defined cases: a null text has size 0; null sources form one source, ordered last; a null id hashes as an
empty string; repeated rows each count; an empty table gives an empty result; sources without words get
target 0; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def sum_before(df: DataFrame, order: list[str | Column], value: str, out: str, within: str | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before, in ``order``, among equal ``within`` (nulls equal).

    The rows are range-sorted once and written. Sums run inside each range; the ranges' totals, one row for
    each range and group, are summed up in turn. ``order`` starts with ``within`` where that is given, so a
    group that holds most rows spreads over many ranges.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    group = [within] if within else []
    keys = ["_part", *group]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_part").alias("_p"), *[F.col(g).alias("_w") for g in group], F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_p")
    if within:
        same &= F.col(within).eqNullSafe(F.col("_w"))
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(offsets, same).withColumn(out, F.col("_local") + F.col("_offset")).drop("_part", "_p", "_w", "_local", "_offset")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) by water filling: shares by weight, none above ``max_epochs`` times its source.

    A source is full when, at the level that would just fill it, all sources together take no more than there is.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_one", F.lit(1).cast("long"))
    ranked = sum_before(per, [F.col("source").asc_nulls_last()], "_one", "_rank")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    capped = ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * max_epochs).alias("cap"))
    capped = capped.withColumn("level", F.col("cap") / F.col("w"))
    order = [F.col("level"), F.col("source").asc_nulls_last()]
    filled = sum_before(sum_before(capped, order, "cap", "cap_before"), order, "w", "w_before")
    total = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all_size"), F.coalesce(F.sum("w"), F.lit(0)).alias("all_w"))
    full = (F.col("cap_before") + F.col("cap")) * F.col("w") + F.col("cap") * (F.col("all_w") - F.col("w_before") - F.col("w")) <= F.col("all_size") * F.col("w")
    judged = filled.join(F.broadcast(total)).withColumn("full", full)  # total is one row
    used = judged.agg(
        F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)).alias("full_cap"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))), F.lit(0)).alias("full_w"),
    )
    share = ((F.col("all_size") - F.col("full_cap")) * F.col("w")).cast("double") / (F.col("all_w") - F.col("full_w")).cast("double")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share)
    return judged.join(F.broadcast(used)).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, taken): words that the mix takes of each document, repeats counted."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    key = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sizes = materialize(docs.select(F.col("doc_id").cast("long"), "source", F.xxhash64("text").alias("text_hash"), size.alias("size"), key.alias("key")))
    targets = materialize(source_targets(sizes, weights, max_epochs))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_hash")]
    placed = sum_before(sizes, order, "size", "before", within="source")
    named = targets.withColumnRenamed("source", "_source")
    budget = F.floor("target")
    rest = budget % F.col("source_size") - F.col("before")
    taken = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")) * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).otherwise(F.lit(0))
    joined = placed.join(named, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select("doc_id", "source", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


OP8_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
caps AS (
  SELECT *, source_size * 3 AS cap, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM per),
filled AS (
  SELECT *, sum(cap) OVER o AS cap_upto, sum(w) OVER o AS w_upto, sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w
  FROM caps WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
judged AS (SELECT *, cap_upto * w + cap * (all_w - w_upto) <= all_size * w AS is_full FROM filled),
used AS (SELECT coalesce(sum(cap) FILTER (is_full), 0) AS full_cap, coalesce(sum(w) FILTER (is_full), 0) AS full_w FROM judged),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE ELSE ((all_size - full_cap) * w)::DOUBLE / (all_w - full_w)::DOUBLE END AS target
  FROM judged, used),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sizes)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CASE WHEN t.source_size > 0
            THEN (floor(t.target)::BIGINT // t.source_size) * p.size
                 + greatest(0, least(p.size, floor(t.target)::BIGINT % t.source_size - p.before))
            ELSE 0 END::BIGINT AS taken,
       p.source
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""
