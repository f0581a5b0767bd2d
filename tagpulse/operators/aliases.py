"""Alias closure and the tag lookup."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard, written


DOUBLINGS = 3  # rounds of doubling between two writes


def _double(step: DataFrame) -> DataFrame:
    ahead = step.select(F.col("antecedent_name").alias("next"), F.col("next").alias("_next"), F.col("least").alias("_least"))
    joined = step.join(ahead, "next", "left")
    return joined.select("antecedent_name", F.coalesce("_next", "next").alias("next"), F.least("least", F.coalesce("_least", "least")).alias("least"))


def resolve_aliases(edges: DataFrame, order: str | None = None, max_depth: int | None = None) -> DataFrame:
    """(antecedent_name, consequent_name) with every chain followed to its end; a cycle ends at its smallest name.

    Pointer doubling: each round joins the table to itself, so chains of length n take log2(n) rounds, and
    carries the smallest name met. Of repeated antecedents the row with the greatest ``order`` holds (the greatest
    consequent without one). Every few rounds are written to the shared folder, so plans stay short; it ends when
    nothing changes.
    """
    last = F.max_by("consequent_name", F.struct(order, "consequent_name") if order else F.col("consequent_name"))
    step = written(edges.groupBy("antecedent_name").agg(last.alias("next")).withColumn("least", F.least("antecedent_name", "next")))
    count, before = step.count(), None
    for _ in range(math.ceil((math.log2(max(2, min(count, max_depth or count))) + 1) / DOUBLINGS) + 1):
        old = step
        for _ in range(DOUBLINGS):
            step = _double(step)
        step = written(step)
        discard(old)
        now = step.agg(F.sum(F.xxhash64("antecedent_name", "next", "least").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # what still points at an antecedent leads into a cycle: its smallest name lies ahead of that pointer
    cycle = step.select(F.col("antecedent_name").alias("next"), F.col("least").alias("_cycle"))
    return step.join(cycle, "next", "left").select("antecedent_name", F.coalesce("_cycle", "next").alias("consequent_name"))


def tag_lookup(dim: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, tag_id): canonical names, and resolved aliases that override a tag of the same name."""
    canonical = dim.select("name", "tag_id", F.lit(0).alias("priority"))
    resolved = aliases.join(dim.select(F.col("name").alias("consequent_name"), "tag_id"), "consequent_name")
    both = canonical.unionByName(resolved.select(F.col("antecedent_name").alias("name"), "tag_id", F.lit(1).alias("priority")))
    return both.groupBy("name").agg(F.max_by("tag_id", "priority").alias("tag_id"))

