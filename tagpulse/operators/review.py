"""Review of names: targets, batches, answers, proposals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.han import Converter
from .names import filled, override_union

#: Fixed value: the longest answer, in characters.
MAX_LENGTH = 60


def in_categories(df: DataFrame, categories: tuple[int, ...] | None) -> DataFrame:
    return df if categories is None else df.where(F.col("category").isin(*categories))


def min_posts(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col("post_count") >= n)


def accept_translations(df: DataFrame) -> DataFrame:
    """(tag, name, reason): null reason is accepted, else why a translation of an ordinary word is skipped."""
    name = F.trim("name")
    reason = F.when(~filled(name), "empty").when(name == F.col("tag"), "same-as-slug").when(~T.has_han(name), "no-han")
    return df.select("tag", name.alias("name"), reason.alias("reason"))


def ambiguous(buckets: DataFrame) -> DataFrame:
    """Tags with more than one name in a bucket other than English."""
    return buckets.where(F.col("lang") != "en").groupBy("tag", "lang").count().where("count > 1").select("tag").distinct()


def reviewed(layers: list[DataFrame]) -> DataFrame:
    """Tags to which a reviewed layer (tag, value, hans, hant) gives a Chinese name."""
    out = None
    for layer in layers:
        some = layer.where(filled(F.col("value")) | filled(F.col("hans")) | filled(F.col("hant"))).select("tag")
        out = some if out is None else out.union(some)
    return out.distinct()


def review_targets(dim: DataFrame, names: DataFrame, done: DataFrame, pool: DataFrame, mode: str, categories: tuple[int, ...] = (3, 4), floor: int = 1000) -> DataFrame:
    """Tags to name (fill: no simplified name) or to check (review: a name no reviewed layer backs), with anchors."""
    chosen = in_categories(min_posts(dim, floor), categories)
    rows = chosen.join(names.withColumnRenamed("tag", "name"), "name", "left")
    if mode == "fill":
        rows = rows.where(~filled(F.col("zh_hans")))
    else:
        rows = rows.where(filled(F.col("zh_hans"))).join(done.withColumnRenamed("tag", "name"), "name", "left_anti")
    rows = rows.join(pool.select(F.col("tag").alias("name"), F.col("names").alias("aliases")), "name", "left")
    kind = F.when(F.col("category") == 3, "copyright").when(F.col("category") == 4, "character").when(F.col("category") == 5, "meta").otherwise("general")
    aliases = T.first_n(F.filter("aliases", lambda a: a != F.coalesce("en", F.lit(""))), 12)
    empty = lambda c: F.nullif(c, F.lit(""))
    anchors = F.struct(kind.alias("category"), F.col("post_count").alias("posts"), empty(F.col("en")).alias("en"), empty(F.col("ja")).alias("ja"), F.when(F.size(aliases) > 0, aliases).alias("aliases"), (F.col("zh_hans") if mode == "review" else F.lit(None).cast("string")).alias("current_zh"))
    return rows.select(F.col("name").alias("tag"), "post_count", anchors.alias("anchors"))


def most_used(dim: DataFrame, n: int) -> DataFrame:
    return dim.orderBy(F.desc("post_count"), "name").limit(n)


def numbered(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Adds batch: ranks in ``order``, ``size`` rows a batch.

    Ranks are summed over sorted ranges, so no single task sorts all rows.
    """
    from ..sources.shared import written

    ranged = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").count().select(F.col("_part").alias("_p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    ranks = ranged.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    joined = ranks.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))  # a row for each range
    return joined.withColumn("batch", ((F.col("_offset") + F.col("_rank") - 1) / size).cast("int")).drop("_part", "_p", "_offset", "_rank")


def missing_batches(expected: DataFrame, status: DataFrame) -> DataFrame:
    """Batches without an answer file, and those whose file is corrupt."""
    return expected.select("batch").join(status.where(~F.col("corrupt")), "batch", "left_anti").distinct()


def reject_reason(value: Column, tag: Column, conv: Converter) -> Column:
    """The first failing check of an answer; null if it passes."""
    said = F.trim(value)
    return (
        F.when(~filled(said), "empty").when(F.length(said) > MAX_LENGTH, "too-long").when(~T.has_han(said), "no-han").when(T.has_kana(said), "contains-kana")
        .when(~conv.is_simplified(said), "not-simplified").when(F.lower(said) == F.replace(tag, F.lit("_"), F.lit(" ")), "same-as-tag")
    )


def judge(answers: DataFrame, inputs: DataFrame, conv: Converter, review: bool) -> DataFrame:
    """(tag, value, current_zh, verdict): accepted, confirmed (equal to the current name; never written), unknown or a reason."""
    known = inputs.select("tag", F.col("current_zh"), F.lit(True).alias("_in"))
    joined = answers.select("tag", F.trim("value").alias("value")).join(known, "tag", "left")
    confirmed = F.lit(review) & filled(F.col("value")) & (F.col("value") == F.trim(F.coalesce("current_zh", F.lit(""))))
    verdict = F.when(F.col("_in").isNull(), "unknown-tag").when(confirmed, "confirmed").otherwise(F.coalesce(reject_reason(F.col("value"), F.col("tag"), conv), F.lit("accepted")))
    return joined.select("tag", "value", "current_zh", verdict.alias("verdict"))


def merge_answers(answers: DataFrame, inputs: DataFrame, manual: DataFrame, existing: DataFrame, conv: Converter, review: bool = False) -> DataFrame:
    """The merged layer (tag, value): existing rows, accepted answers over them; hand-written answers beat batch ones."""
    said = override_union(answers, manual, ["tag"], ["value"])
    accepted = judge(said, inputs, conv, review).where("verdict = 'accepted'").select("tag", "value")
    return override_union(existing, accepted, ["tag"], ["value"])


def owners(layer: DataFrame) -> DataFrame:
    return layer.groupBy("value").agg(F.count("*").alias("owners"))


def new_collisions(answers: DataFrame, inputs: DataFrame, existing: DataFrame) -> DataFrame:
    """(tag, value, others): answers whose name another tag has, though the name before was the tag's own. Reported only."""
    final = override_union(existing, answers, ["tag"], ["value"])
    counts = owners(final)
    rows = answers.select("tag", "value").join(inputs.select("tag", F.col("current_zh").alias("before")), "tag", "left")
    now = rows.join(counts, "value")
    earlier = counts.select(F.col("value").alias("before"), F.col("owners").alias("before_owners"))
    own_before = final.select("tag", F.col("value").alias("final_value"))
    joined = now.join(earlier, "before", "left").join(own_before, "tag")
    others_before = F.coalesce("before_owners", F.lit(0)) - (F.col("final_value") == F.col("before")).cast("int")
    clash = (F.col("owners") > 1) & ~F.col("value").eqNullSafe(F.col("before")) & ~(filled(F.col("before")) & (F.coalesce(others_before, F.lit(0)) > 0))
    return joined.where(clash).select("tag", "value", (F.col("owners") - 1).alias("others"))


def target_report(targets: DataFrame) -> DataFrame:
    """(category, targets, anchored, rate) of review targets: how many have a name or alias to go by, in whole percent."""
    a = F.col("anchors")
    anchored = a["en"].isNotNull() | a["ja"].isNotNull() | a["aliases"].isNotNull()
    sums = targets.groupBy(a["category"].alias("category")).agg(F.count("*").alias("targets"), F.count_if(anchored).alias("anchored"))
    return sums.select("category", "targets", "anchored", F.expr("anchored * 100 div targets").alias("rate"))


def shared_values(layer: DataFrame) -> DataFrame:
    """Values that more than one tag has."""
    return layer.where(filled(F.col("value"))).groupBy("value").agg(F.count("*").alias("tags")).where("tags > 1")


def confirmation_rate(judged: DataFrame) -> DataFrame:
    """Confirmed answers in whole percent of those judged."""
    sums = judged.where("verdict <> 'unknown-tag'").agg(F.count_if(F.col("verdict") == "confirmed").alias("confirmed"), F.count("*").alias("judged"))
    return sums.select("confirmed", "judged", F.expr("confirmed * 100 div greatest(judged, 1)").alias("rate"))


def reason_report(judged: DataFrame, column: str = "reason", samples: int = 6) -> DataFrame:
    """(reason, n, samples): counts, and the first tags by name, kept small before the shuffle's end."""
    ranked = judged.where(F.col(column).isNotNull()).withColumn("_rn", F.row_number().over(Window.partitionBy(column).orderBy("tag")))
    some = ranked.where(F.col("_rn") <= samples).groupBy(column).agg(F.array_join(F.array_sort(F.collect_list("tag")), ",").alias("samples"))
    return judged.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).join(some, column)


# --- proposals of review rounds


def strip_qualifier(value: Column, labels: Column) -> Column:
    """Without a closing full-width note all of whose parts the disambiguation would add back."""
    note = F.regexp_extract(value, "（([^（）]+)）$", 1)
    known = F.size(F.array_except(F.split(note, "·"), F.coalesce(labels, F.array().cast("array<string>")))) == 0
    return F.when((note != "") & known, F.regexp_replace(value, "（[^（）]+）$", "")).otherwise(value)


def tag_labels(tags: DataFrame, labels: DataFrame) -> DataFrame:
    """(tag, labels): every label of the tag's bracketed qualifiers."""
    each = tags.select("tag", F.explode(T.qualifiers(F.col("tag"))).alias("qualifier"))
    return each.join(labels, "qualifier").where(filled(F.col("label"))).groupBy("tag").agg(F.collect_set("label").alias("labels"))


def last_round_wins(accepted: DataFrame, keys: list[str]) -> DataFrame:
    """Adds rank (1: the row that holds) of a tag's accepted proposals, the latest round and file first."""
    return accepted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("round"), F.desc("file"))))


def judge_targets(proposals: DataFrame, targets: DataFrame, shards: DataFrame, categories: DataFrame, current: DataFrame, conv: Converter, labels: DataFrame | None = None) -> DataFrame:
    """As judge_proposals, for proposals that name their target; (target, categories array, null for all, gap_only) is a table.

    Proposals of an unknown target drop out. A tag's latest proposal holds within its target. Targets are a few settings of the
    review, so they go to all tasks: a shuffle by target would put each one's proposals into one task.
    """
    rows = proposals.join(targets.select("target", F.col("categories").alias("_wanted"), F.coalesce("gap_only", F.lit(False)).alias("_gap_only")).transform(F.broadcast), "target")
    off = F.col("_wanted").isNotNull() & ~F.coalesce(F.array_contains("_wanted", F.col("category")), F.lit(False))
    return _judged(rows, ["target", "tag"], shards, categories, current, conv, off, F.col("_gap_only"), labels)


def judge_proposals(proposals: DataFrame, shards: DataFrame, categories: DataFrame, current: DataFrame, conv: Converter, wanted: tuple[int, ...] | None, labels: DataFrame | None = None, gap_only: bool = False) -> DataFrame:
    """(tag, round, file, value, reason) of proposals (tag, round, file, value); reason is null for what holds.

    With ``labels`` (qualifier, label) notes that the disambiguation adds back are cut from both sides first.
    """
    off = F.lit(False) if wanted is None else ~F.coalesce(F.col("category").isin(*wanted), F.lit(False))
    return _judged(proposals, ["tag"], shards, categories, current, conv, off, F.lit(gap_only), labels)


def _judged(proposals: DataFrame, keys: list[str], shards: DataFrame, categories: DataFrame, current: DataFrame, conv: Converter, off: Column, gap_only: Column, labels: DataFrame | None) -> DataFrame:
    rows = proposals.withColumn("value", F.trim(F.coalesce("value", F.lit(""))))
    rows = rows.join(current.select("tag", F.col("value").alias("now")), "tag", "left").join(categories.select(F.col("name").alias("tag"), "category"), "tag", "left")
    rows = rows.join(shards.select("tag", F.lit(True).alias("in_shard")).distinct(), "tag", "left")
    before = F.col("now")
    if labels is not None:
        rows = rows.join(tag_labels(rows.select("tag").distinct(), labels), "tag", "left").withColumn("value", F.when(filled(F.col("value")), strip_qualifier(F.col("value"), F.col("labels"))).otherwise(F.col("value")))
        before = F.when(filled(F.col("now")), strip_qualifier(F.col("now"), F.col("labels"))).otherwise(F.col("now"))
    reason = (
        F.when(F.col("in_shard").isNull(), "not in a shard").when(off, "wrong category").when(~filled(F.col("value")), "empty")
        .when(gap_only & filled(F.col("now")), "already named").when(F.col("value").eqNullSafe(before), "unchanged").when(~conv.is_simplified(F.col("value")), "not simplified")
    )
    judged = rows.select(*keys, "round", "file", "value", reason.alias("reason"))
    ranked = last_round_wins(judged.where("reason is null"), keys)
    latest = Window.partitionBy(*keys).orderBy("rank")
    ranked = ranked.withColumn("later", F.lag("value").over(latest))
    superseded = F.when((F.col("rank") > 1) & (F.col("value") != F.col("later")), "superseded").when(F.col("rank") > 1, "repeated")
    return judged.where("reason is not null").unionByName(ranked.select(*keys, "round", "file", "value", superseded.alias("reason")))


def merge_layer(existing: DataFrame, accepted: DataFrame, prefer: str = "accepted") -> DataFrame:
    return override_union(existing, accepted, ["tag"], ["value"]) if prefer == "accepted" else override_union(accepted, existing, ["tag"], ["value"])


def hand_conflicts(existing: DataFrame, accepted: DataFrame) -> DataFrame:
    """Hand-fixed values that a proposal would change; they are kept, and listed."""
    return existing.join(accepted.select("tag", F.col("value").alias("proposed")), "tag").where("value <> proposed")


def merge_rejections(proposed: DataFrame, shards: DataFrame, categories: DataFrame, existing: DataFrame, legacy: DataFrame) -> DataFrame:
    """(tag, legacy_zh, reason): proposed rejections, a null reason for those to add."""
    rows = proposed.select("tag").distinct().join(categories.select(F.col("name").alias("tag"), "category"), "tag", "left")
    rows = rows.join(shards.select("tag", F.lit(True).alias("in_shard")).distinct(), "tag", "left").join(existing.select("tag", F.lit(True).alias("known")).distinct(), "tag", "left").join(legacy.select("tag", "legacy_zh"), "tag", "left")
    reason = F.when(F.col("in_shard").isNull(), "not in a shard").when(~F.coalesce(F.col("category").isin(0, 3, 5), F.lit(False)), "wrong category").when(F.col("known"), "already rejected").when(~filled(F.col("legacy_zh")), "no rejected value")
    return rows.select("tag", "legacy_zh", reason.alias("reason"))


@dataclass(frozen=True)
class FamilyRule:
    """Tags of a pattern, but for exceptions, take names of a pattern."""

    tag: str
    name: str
    message: str
    exceptions: tuple[str, ...] = ()


#: The families' formats and their exceptions.
FAMILY_RULES = (
    FamilyRule("^bad_.*_id$", "^失效", "bad_*_id"),
    FamilyRule("_pull$", "^拉", "*_pull", ("cord_pull",)),
    FamilyRule("_tug$", "^拉扯", "*_tug"),
    FamilyRule("_lift$", "^掀起", "*_lift", ("leg_lift", "breast_lift", "ass_lift", "pectoral_lift", "hair_lift", "chin_lift", "arm_lift", "wind_lift")),
    FamilyRule("^spoken_", "^对话框", "spoken_*"),
    FamilyRule(r"_\(medium\)$", "（媒介）$", "*_(medium)"),
    FamilyRule("^cum_on_", "^射在", "cum_on_*"),
    FamilyRule("^unworn_", "^(未穿|未戴)", "unworn_*"),
    FamilyRule("_censor$", "打码|遮挡|^圣光$", "*_censor", ("bar_censor",)),
)


def format_warnings(df: DataFrame, rules: tuple[FamilyRule, ...] = FAMILY_RULES) -> DataFrame:
    """(tag, value, rule): names outside their family's format; reported only."""
    broken = F.array(*[F.when(F.col("tag").rlike(r.tag) & ~F.col("tag").isin(*(r.exceptions or ("",))) & ~F.col("value").rlike(r.name), r.message) for r in rules])
    return df.select("tag", "value", F.explode(F.filter(broken, lambda m: m.isNotNull())).alias("rule"))
