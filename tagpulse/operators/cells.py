"""Posts to daily cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_of, split_tags, strict_day
from ..schemas import ARTIST

#: The index's first day, and the number of days it can hold.
FIRST_DAY, DAYS = "2005-01-01", 32768


def tag_dim(tags: DataFrame, min_posts: int = 100, excluded: int | None = ARTIST) -> DataFrame:
    """(tag_id, name, category, post_count, is_deprecated) of tags over the floor, outside the excluded category.

    Deprecated tags stay and are flagged. A null category is left out with the excluded one.
    """
    kept = tags.where(F.col("post_count") >= min_posts)
    if excluded is not None:
        kept = kept.where(F.col("category") != excluded)
    return kept.select(
        F.col("id").cast("int").alias("tag_id"), "name", F.col("category").cast("byte").alias("category"), F.col("post_count").cast("long").alias("post_count"),
        (F.coalesce("is_deprecated", F.lit(0)) != 0).alias("is_deprecated"),
    )


def live_posts(posts: DataFrame, include_deleted: bool = False, max_id: int | None = None) -> DataFrame:
    """The four columns that are counted; deleted posts out unless asked (null: not deleted), ids below ``max_id``."""
    kept = posts.where(F.col("created_at").isNotNull() & F.col("tag_string").isNotNull())
    if not include_deleted:
        kept = kept.where("is_deleted IS NULL OR is_deleted = 0")  # in a form that a scan takes over
    if max_id is not None:
        kept = kept.where(F.col("id") < max_id)
    zero = F.lit(0)
    return kept.select("created_at", "tag_string", F.coalesce("fav_count", zero).cast("long").alias("fav"), F.coalesce("score", zero).cast("long").alias("score"))


def with_day(posts: DataFrame, first_day: str = FIRST_DAY) -> DataFrame:
    """Posts with a valid day in the index's range; others drop out of cells and totals alike."""
    day = strict_day(F.col("created_at"))
    return posts.withColumn("day", day).where((F.col("day") >= F.lit(first_day).cast("date")) & (F.col("day") < F.date_add(F.lit(first_day).cast("date"), DAYS)))


def _sums() -> list:
    return [F.count("*").alias("posts"), F.sum("fav").alias("fav_sum"), F.sum("score").alias("score_sum")]


def name_cells(dated: DataFrame) -> DataFrame:
    """(name, day) cells by raw tag name: the eager half of the aggregation, before any lookup."""
    each = dated.select("day", "fav", "score", F.explode(split_tags(F.col("tag_string"))).alias("name"))
    return each.groupBy("name", "day").agg(*_sums())


def cells_of_names(named: DataFrame, lookup: DataFrame) -> DataFrame:
    """(tag_id, day) cells of raw-name cells. A post under a tag and its alias counts twice; unknown names drop out.

    Whether the lookup is broadcast is left to adaptive execution, which knows its bytes.
    """
    sums = [F.sum(c).alias(c) for c in ("posts", "fav_sum", "score_sum")]
    return named.join(lookup, "name").groupBy("tag_id", "day").agg(*sums)


def daily_cells(posts: DataFrame, lookup: DataFrame, first_day: str = FIRST_DAY, **options) -> DataFrame:
    """(tag_id, day, posts, fav_sum, score_sum), aggregated by raw name first, so the join sees cells, not pairs."""
    return cells_of_names(name_cells(with_day(live_posts(posts, **options), first_day)), lookup)


def monthly_cells(posts: DataFrame, lookup: DataFrame, first_day: str = FIRST_DAY, **options) -> DataFrame:
    """(tag_id, month, posts, fav_sum, score_sum): daily cells by month, without aggregating by day first."""
    dated = with_day(live_posts(posts, **options), first_day).withColumn("day", month_of(F.col("day")))
    return cells_of_names(name_cells(dated), lookup).withColumnRenamed("day", "month")


def daily_totals(posts: DataFrame, first_day: str = FIRST_DAY, **options) -> DataFrame:
    """(day, posts, fav_sum, score_sum): posts, not tag occurrences, with or without a kept tag."""
    return with_day(live_posts(posts, **options), first_day).groupBy("day").agg(*_sums())


def next_id(posts: DataFrame) -> DataFrame:
    return posts.agg((F.coalesce(F.max("id"), F.lit(-1)) + 1).cast("long").alias("max_id"))
