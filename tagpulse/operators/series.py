"""Rollups, month axis, metrics and smoothing."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import month_index, month_of, upper_median

SUMS = ("posts", "fav_sum", "score_sum")


def merge_cells(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partial cells of slices added up."""
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def monthly(daily: DataFrame, *keys: str) -> DataFrame:
    """Daily cells by month, for each of ``keys`` (none: the totals)."""
    return daily.groupBy(*keys, month_of(F.col("day")).alias("month")).agg(*[F.sum(c).alias(c) for c in SUMS])


def category_monthly(tag_months: DataFrame, dim: DataFrame) -> DataFrame:
    """(category, month, posts, n_eff, active_tags); n_eff is 1 over the sum of squared shares.

    Sums and sums of squares meet in one aggregate, which combines before the shuffle; no window is needed.
    """
    joined = tag_months.join(dim.select("tag_id", "category"), "tag_id")
    posts = F.col("posts").cast("double")
    sums = joined.groupBy("category", "month").agg(F.sum("posts").alias("posts"), F.sum(posts * posts).alias("squares"), F.count("*").alias("active_tags"))
    n_eff = F.try_divide(F.col("posts").cast("double") * F.col("posts"), F.col("squares"))
    return sums.select("category", "month", "posts", n_eff.alias("n_eff"), "active_tags")


def category_share(tag_months: DataFrame, dim: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """tag months with category, name and s: the share of the category's month."""
    categories = category_monthly(tag_months, dim) if categories is None else categories
    whole = categories.select("category", "month", F.col("posts").alias("category_posts"), "n_eff", "active_tags")
    named = tag_months.join(dim.select("tag_id", "name", "category"), "tag_id")
    return named.join(whole, ["category", "month"]).withColumn("s", F.col("posts") / F.col("category_posts"))


def relative(tag_months: DataFrame, dim: DataFrame) -> DataFrame:
    """Relative index s / (HHI - s * s); 1 is a typical competitor. Months in which a tag is alone drop out."""
    shares = category_share(tag_months, dim).where("active_tags > 1")
    return shares.select("name", "category", "month", "posts", (F.col("s") / (1 / F.col("n_eff") - F.col("s") * F.col("s"))).alias("relative"))


def share(tag_months: DataFrame, totals: DataFrame, dim: DataFrame) -> DataFrame:
    """Posts under the tag among 10000 posts of the month."""
    whole = totals.select("month", F.col("posts").alias("all_posts"))
    named = tag_months.join(dim.select("tag_id", "name"), "tag_id").join(whole, "month")
    return named.select("name", "month", "posts", (F.col("posts") * 10000 / F.col("all_posts")).alias("share"))


def metric(tag_months: DataFrame, dim: DataFrame, totals: DataFrame, kind: str) -> DataFrame:
    """(name, month, value) by posts, share or relative."""
    if kind == "posts":
        return tag_months.join(dim.select("tag_id", "name"), "tag_id").select("name", "month", F.col("posts").cast("double").alias("value"))
    df = share(tag_months, totals, dim) if kind == "share" else relative(tag_months, dim)
    return df.select("name", "month", F.col(kind).alias("value"))


def month_axis(totals: DataFrame) -> DataFrame:
    """(i, month, posts): every month from the first to the last, months without posts at 0."""
    span = totals.agg(F.min("month").alias("a"), F.max("month").alias("z")).where("a is not null")
    months = span.select(F.posexplode(F.expr("sequence(a, z, interval 1 month)")).alias("i", "month"))
    return months.join(totals.select("month", "posts"), "month", "left").select("i", "month", F.coalesce("posts", F.lit(0)).alias("posts"))


def complete_months(totals: DataFrame) -> DataFrame:
    """(first, last): indices of the first and last complete month.

    Under 14 months all count. Else the last goes if below 0.6 of the upper median of the twelve before it, the
    first if below 0.6 of that of the twelve after it.
    """
    ordered = totals.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "posts"))), lambda x: x["posts"]).alias("p"))
    n = F.size("p")
    low_end = F.element_at("p", -1) < upper_median(F.slice("p", n - 12, 12)) * 0.6
    low_start = F.element_at("p", 1) < upper_median(F.slice("p", 2, 12)) * 0.6
    return ordered.where(n > 0).select(F.when(n < 14, 0).when(low_start, 1).otherwise(0).alias("first"), F.when(n < 14, n - 1).when(low_end, n - 2).otherwise(n - 1).alias("last"))


def indexed(df: DataFrame, axis: DataFrame) -> DataFrame:
    """``df`` with i, its month's place on the axis (one row of epoch is broadcast)."""
    epoch = axis.agg(F.min("month").alias("_epoch"))
    return df.crossJoin(F.broadcast(epoch)).withColumn("i", month_index(F.col("month"), F.col("_epoch"))).drop("_epoch")


def dense_series(values: DataFrame, axis: DataFrame, key: str, value: str, full_axis: bool = False) -> DataFrame:
    """(key, i, value): zero-filled from a key's first to its last month, or over the whole axis."""
    placed = indexed(values, axis).where("i >= 0").select(key, "i", value)
    if full_axis:
        months = axis.select(F.col("i").alias("_i"))
        runs = placed.select(key).distinct().crossJoin(F.broadcast(months)).select(key, F.col("_i").alias("i"))
        placed = placed.join(F.broadcast(months), placed["i"] == months["_i"]).drop("_i")
    else:
        # each row brings the empty months up to the key's next one, so one shuffle by key does, also for a window that follows
        following = F.lead("i").over(Window.partitionBy(key).orderBy("i"))
        spans = placed.withColumn("_last", F.greatest(F.coalesce(following - 1, "i"), "i"))
        filled = spans.select(key, F.col("i").alias("_i"), value, F.explode(F.sequence("i", "_last")).alias("i"))
        return filled.select(key, "i", F.when(F.col("i") == F.col("_i"), F.coalesce(value, F.lit(0))).otherwise(0).alias(value))
    return runs.join(placed, [key, "i"], "left").select(key, "i", F.coalesce(value, F.lit(0)).alias(value))


def dense_categories(categories: DataFrame, axis: DataFrame) -> DataFrame:
    """(category, i, posts, n_eff) over the whole axis; months outside it drop, missing ones are 0."""
    placed = indexed(categories, axis).select("category", "i", "posts", "n_eff")
    runs = placed.select("category").distinct().crossJoin(F.broadcast(axis.select("i")))
    joined = runs.join(placed, ["category", "i"], "left")
    return joined.select("category", "i", F.coalesce("posts", F.lit(0)).alias("posts"), F.coalesce("n_eff", F.lit(0.0)).alias("n_eff"))


def series_arrays(tag_months: DataFrame, dim: DataFrame, axis: DataFrame, min_posts: int = 0) -> DataFrame:
    """(name, category, post_count, first_i, last_i, months, values): a row a tag, arrays in month order.

    Months meet by tag_id before the dimension is joined, so they are shuffled once.
    """
    ordered = F.array_sort(F.collect_list(F.struct("i", "posts")))
    runs = indexed(tag_months, axis).groupBy("tag_id").agg(F.min("i").alias("first_i"), F.max("i").alias("last_i"), ordered.alias("run"))
    kept = runs.join(dim.where(F.col("post_count") >= min_posts), "tag_id")
    return kept.select("name", "category", "post_count", "first_i", "last_i", F.col("run.i").alias("months"), F.col("run.posts").alias("values"))


def moving_average(series: DataFrame, key: str, value: str, window: int = 9) -> DataFrame:
    """Centred mean over window // 2 months on either side, cut short at both ends."""
    half = window // 2
    frame = Window.partitionBy(key).orderBy("i").rowsBetween(-half, half)
    return series.select(key, "i", F.avg(value).over(frame).alias("smoothed"))


def smooth(series: DataFrame, key: str, value: str, window: int) -> DataFrame:
    """Local linear fit with Gaussian weights, read at its centre; window 0 leaves values as they are.

    ``series`` is dense: a key's i are consecutive. So neighbours are read by offset, and weights are constants of the plan.

    Half window window / 2, deviation a quarter of the window. At the edges the line keeps the trend, which a mean
    does not.
    """
    if window <= 0:
        return series.select(key, "i", F.col(value).cast("double").alias("smoothed"))
    half = window / 2
    reach = int(half)
    sigma = half / 2
    order = Window.partitionBy(key).orderBy("i")
    y = F.col(value).cast("double")
    near = series.select(key, "i", *[F.lag(y, -d).over(order).alias(f"_{d + reach}") for d in range(-reach, reach + 1)])

    def total(power: int, of_values: bool):
        """Sum of weight * offset ** power, times the value if asked, over the neighbours that exist."""
        terms = []
        for d in range(-reach, reach + 1):
            w, there = float(math.exp(-d * d / (2 * sigma * sigma)) * d**power), F.col(f"_{d + reach}")
            terms.append(F.coalesce(there * w, F.lit(0.0)) if of_values else F.when(there.isNotNull(), w).otherwise(0.0))
        return reduce(lambda p, q: p + q, terms)

    sums = near.select(key, "i", total(0, False).alias("s0"), total(1, False).alias("s1"), total(2, False).alias("s2"), total(0, True).alias("t0"), total(1, True).alias("t1"))
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    line = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det
    return sums.select(key, "i", F.when(det > 1e-12, line).otherwise(F.col("t0") / F.col("s0")).alias("smoothed"))


def trim_start(smoothed: DataFrame, raw: DataFrame, key: str, value: str) -> DataFrame:
    """A smoothed series from the first month in which the raw one is above zero."""
    starts = raw.where(F.col(value) > 0).groupBy(key).agg(F.min("i").alias("start"))
    return smoothed.join(starts, key).where("i >= start").drop("start")


def peak(smoothed: DataFrame) -> DataFrame:
    return smoothed.agg(F.max("smoothed").alias("peak"))


def value_at(series: DataFrame, axis: DataFrame, value: str, month: int | None = None) -> DataFrame:
    """Values at a month index, by default that of the last complete month."""
    if month is not None:
        return series.where(F.col("i") == month)
    last = complete_months(axis).select(F.col("last").alias("_last"))
    return series.join(F.broadcast(last), F.col("i") == F.col("_last")).drop("_last")


def chart(tag_months: DataFrame, dim: DataFrame, totals: DataFrame, names: list[str], kind: str = "posts", from_: int | None = None, to: int | None = None, window: int = 12) -> DataFrame:
    """(name, i, month, value, smoothed) of the named tags; partial months take no part in the fit or the result."""
    axis = month_axis(totals)
    chosen = dim.where(F.col("name").isin(names))
    months = tag_months if kind == "relative" else tag_months.join(F.broadcast(chosen.select("tag_id")), "tag_id", "left_semi")
    values = metric(months, dim, totals, kind).where(F.col("name").isin(names))
    whole = complete_months(axis)
    dense = dense_series(values, axis, "name", "value").join(F.broadcast(whole), F.expr("i between first and last")).drop("first", "last")
    shown = trim_start(smooth(dense, "name", "value", window), dense, "name", "value").join(dense, ["name", "i"]).join(axis.select("i", "month"), "i")
    if from_ is not None:
        shown = shown.where(F.col("i") >= from_)
    if to is not None:
        shown = shown.where(F.col("i") <= to)
    return shown.select("name", "i", "month", "value", "smoothed")
