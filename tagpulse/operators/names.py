"""Display names: alias buckets, picks, layers, disambiguation.

Names are a wide table: tag, one column a language, and ``rejected`` (a review found no Chinese name). A null slot of
a rejected tag is "rejected", any other null slot is "absent".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.han import Converter, strip_ja
from ..schemas import LANGS
from ..sources.shared import written

CHINESE = ("zh_hans", "zh_hant")


def filled(col: Column) -> Column:
    return F.coalesce(col != "", F.lit(False))


# --- from the alias pool to one pick a language


def wiki_names(tags: DataFrame, wiki: DataFrame, category: int | None = None) -> DataFrame:
    """(tag, pos, name): live wiki names of used tags, trimmed, the first of repeats."""
    used = tags.where(F.col("post_count") > 0)
    if category is not None:
        used = used.where(F.col("category") == category)
    live = wiki.where(F.coalesce(F.col("is_deleted") == 0, F.lit(False)))
    names = F.posexplode(F.from_json("other_names", "array<string>")).alias("pos", "name")
    each = used.select("name").withColumnRenamed("name", "tag").join(live, F.col("title") == F.col("tag")).select("tag", names)
    return each.select("tag", "pos", F.trim("name").alias("name")).where(filled(F.col("name"))).groupBy("tag", "name").agg(F.min("pos").alias("pos"))


def classify(name: Column, conv: Converter) -> Column:
    """Language by script: Hangul ko, kana ja, Han by its forms, else en."""
    return F.when(name.rlike(T.HANGUL_BUCKET), "ko").when(T.has_kana(name), "ja").when(T.has_han(name), conv.han_lang(name)).otherwise("en")


def bucket_aliases(names: DataFrame, conv: Converter, overrides: DataFrame | None = None) -> DataFrame:
    """(tag, lang, pos, name). An override (name, langs) replaces the detected language of a Han name, by any number."""
    if overrides is None:
        return names.select("tag", classify(F.col("name"), conv).alias("lang"), "pos", "name")
    found = names.join(overrides, "name", "left")
    han = T.has_han(F.col("name")) & ~T.has_kana(F.col("name")) & ~F.col("name").rlike(T.HANGUL_BUCKET) & F.coalesce(F.size("langs") > 0, F.lit(False))
    return found.select("tag", F.explode(F.when(han, F.col("langs")).otherwise(F.array(classify(F.col("name"), conv)))).alias("lang"), "pos", "name")


def candidates(buckets: DataFrame) -> DataFrame:
    return buckets.withColumn("name", F.trim(F.replace("name", F.lit("_"), F.lit(" ")))).where(F.col("name") != "")


def pick(buckets: DataFrame, how: str = "primary") -> DataFrame:
    """(tag, lang, name): the first name of each bucket, or the shortest (the first on a tie)."""
    order = F.col("pos") if how == "primary" else F.struct(F.char_length("name"), "pos")
    return candidates(buckets).groupBy("tag", "lang").agg(F.min_by("name", order).alias("name"))


def widen(picks: DataFrame, langs: tuple[str, ...] = LANGS) -> DataFrame:
    return picks.groupBy("tag").agg(*[F.max(F.when(F.col("lang") == lang, F.col("name"))).alias(lang) for lang in langs])


def pick_copyright(buckets: DataFrame) -> DataFrame:
    """Primary names in four languages; English comes from elsewhere."""
    return widen(pick(buckets)).withColumn("en", F.lit(None).cast("string"))


def pick_character(buckets: DataFrame) -> DataFrame:
    """Primary names, without a closing note where the slug has a qualifier; English from the slug.

    Where both Chinese slots are empty, the first Han-only name of the Japanese bucket gives the simplified one.
    """
    wide = widen(pick(buckets))
    noted = F.col("tag").rlike(r"_\([^()]*\)$")
    trimmed = {lang: F.when(noted, T.strip_trailing_bracket(F.col(lang))).otherwise(F.col(lang)) for lang in LANGS if lang != "en"}
    seeds = candidates(buckets).where((F.col("lang") == "ja") & T.is_han_name(F.col("name"))).groupBy("tag").agg(F.min_by("name", "pos").alias("seed"))
    joined = wide.withColumns(trimmed | {"en": T.character_en(F.col("tag"))}).join(seeds, "tag", "left")
    return joined.withColumn("zh_hans", F.when(F.col("zh_hans").isNull() & F.col("zh_hant").isNull(), F.col("seed")).otherwise(F.col("zh_hans"))).drop("seed")


def fill_scripts(names: DataFrame, conv: Converter) -> DataFrame:
    """Missing Chinese and Japanese slots from the first Han-only one; without any, a Latin Chinese name is mirrored."""
    names = names.withColumns({c: strip_ja(F.col(c)) for c in LANGS})
    hans, hant, ja = (F.col(c) for c in ("zh_hans", "zh_hant", "ja"))
    base = F.when(T.is_han_name(hant), hant).when(T.is_han_name(hans), conv.plain(hans, "s2t")).when(T.is_han_name(ja), conv.plain(ja, "jp2t"))
    based = names.withColumn("_base", base)
    b = F.col("_base")
    empty = lambda c: ~filled(c)
    return based.withColumns(
        {
            "zh_hant": F.when(empty(hant), F.coalesce(b, F.when(filled(hans), hans), hant)).otherwise(hant),
            "zh_hans": F.when(empty(hans), F.coalesce(conv.plain(b, "t2s"), F.when(filled(hant), hant), hans)).otherwise(hans),
            "ja": F.when(empty(ja) & b.isNotNull(), conv.to_ja(b)).otherwise(ja),
        }
    ).drop("_base")


def normalize_chinese(names: DataFrame, conv: Converter) -> DataFrame:
    return names.withColumns({"zh_hans": conv.repair_simplified(F.col("zh_hans")), "zh_hant": conv.repair_traditional(F.col("zh_hant"))})


def build_map(buckets: DataFrame, picker: Callable[[DataFrame], DataFrame], conv: Converter, official: DataFrame | None = None, en_override=None, en_fallback=None) -> DataFrame:
    """Picks, an official entry in place of a tag's pick, English by rule, then scripts filled and normalised."""
    chosen = buckets.select("tag").distinct().join(picker(buckets), "tag", "left")
    if official is not None:
        theirs = official.select("tag", *[F.nullif(F.col(c), F.lit("")).alias(f"_{c}") for c in LANGS], F.lit(True).alias("_has"))
        joined = chosen.join(theirs, "tag", "left")
        chosen = joined.select("tag", *[F.when(F.coalesce("_has", F.lit(False)), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in LANGS])
    if en_override is not None:
        chosen = chosen.withColumn("en", en_override(F.col("tag")))
    elif en_fallback is not None:
        chosen = chosen.withColumn("en", F.when(filled(F.col("en")), F.col("en")).otherwise(en_fallback(F.col("tag"))))
    return normalize_chinese(fill_scripts(chosen, conv), conv)


# --- layers, in the order of their trust


def first_wins(rows: DataFrame, keys: list[str], value: str, priority: str) -> DataFrame:
    """The non-empty value of least priority number for each key."""
    return rows.where(filled(F.col(value))).groupBy(*keys).agg(F.min_by(value, priority).alias(value))


def base_names(maps: list[DataFrame], wanted: DataFrame | None = None) -> DataFrame:
    """Wide names of (tag, lang, name) maps; an earlier map wins a slot."""
    rows = None
    for k, m in enumerate(maps):
        part = m.select("tag", "lang", "name", F.lit(k).alias("priority"))
        rows = part if rows is None else rows.unionByName(part)
    return widen(first_wins(only(rows, wanted), ["tag", "lang"], "name", "priority")).withColumn("rejected", F.lit(False))


def only(df: DataFrame, wanted: DataFrame | None) -> DataFrame:
    return df if wanted is None else df.join(wanted.select("tag").distinct(), "tag", "left_semi")


def anti(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.join(other.select("tag").distinct(), "tag", "left_anti")


def override_union(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """All keys of both; where both have one, b's row."""
    theirs = b.select(*keys, *[F.col(v).alias(f"_{v}") for v in values], F.lit(True).alias("_has"))
    both = a.select(*keys, *values).join(theirs, keys, "full")
    return both.select(*keys, *[F.when(F.coalesce("_has", F.lit(False)), F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in values])


def _full(names: DataFrame, layer: DataFrame) -> DataFrame:
    return names.join(layer, "tag", "full").withColumn("rejected", F.coalesce("rejected", F.lit(False)))


def fill_layer(names: DataFrame, layer: DataFrame, conv: Converter) -> DataFrame:
    """(tag, value) gives the simplified name only where there is none, and with it an empty traditional one."""
    joined = _full(names, layer.where(filled(F.col("value"))).select("tag", F.col("value").alias("_new")))
    gap = F.col("_new").isNotNull() & ~filled(F.col("zh_hans"))
    hant = F.when(gap & ~filled(F.col("zh_hant")), conv.traditional(F.col("_new"))).otherwise(F.col("zh_hant"))
    return joined.withColumns({"zh_hant": hant, "zh_hans": F.when(gap, F.col("_new")).otherwise(F.col("zh_hans"))}).drop("_new")


def override_layer(names: DataFrame, layer: DataFrame, conv: Converter) -> DataFrame:
    """(tag, value, hans, hant): a value asserts the simplified name; hans and hant set their script alone.

    With a value the traditional name follows only where it is empty or is a conversion of the former simplified one.
    """
    joined = _full(names, layer.select("tag", F.col("value").alias("_all"), F.col("hans").alias("_hans"), F.col("hant").alias("_hant")))
    now, trad, new = F.col("zh_hans"), F.col("zh_hant"), F.col("_all")
    moved = filled(new) & ~F.coalesce(now == new, F.lit(False))
    derived = ~filled(trad) | (filled(now) & (conv.simplify(trad) == now))
    hans = F.when(moved, new).when(~filled(new) & filled(F.col("_hans")), F.col("_hans")).otherwise(now)
    hant = F.when(moved & derived, conv.traditional(new)).when(~filled(new) & filled(F.col("_hant")), F.col("_hant")).otherwise(trad)
    return joined.withColumns({"zh_hans": hans, "zh_hant": hant}).drop("_all", "_hans", "_hant")


def reject_layer(names: DataFrame, rejected: DataFrame) -> DataFrame:
    """Both Chinese slots become null and the tag is marked, also a tag that was never named."""
    joined = _full(names, rejected.select("tag", F.lit(True).alias("_no")).distinct())
    no = F.coalesce("_no", F.lit(False))
    return joined.withColumns({c: F.when(~no, F.col(c)) for c in CHINESE} | {"rejected": F.col("rejected") | no}).drop("_no")


def characters(names: DataFrame, copyrights: DataFrame, ordinary: DataFrame) -> DataFrame:
    """Tags that are neither a copyright nor ordinary vocabulary."""
    return anti(anti(names.select("tag"), copyrights), ordinary)


def marks(members: DataFrame) -> DataFrame:
    """(tag, name, marks, plainest, sole) of tags that share a name with another.

    Marks are what sets a tag apart: the prefix by which its stem extends another stem of the group, and its
    bracketed qualifiers that not all of the group have. All by joins and counts; no group is ever collected.
    """
    sized = members.join(members.groupBy("name").agg(F.count("*").alias("group_size")).where("group_size > 1"), "name")
    parts = sized.select("tag", "name", "group_size", T.qualifiers(F.col("tag")).alias("q"), T.stem(F.col("tag")).alias("stem"))
    each = parts.select("name", "group_size", F.explode(F.array_distinct("q")).alias("one"))
    common = each.groupBy("name", "one", "group_size").count().where("count = group_size").groupBy("name").agg(F.collect_set("one").alias("common"))
    tails = parts.select("tag", "name", "stem", F.explode(F.transform(F.sequence(F.lit(1), F.length("stem")), lambda k: F.substring("stem", k + 1, F.lit(1 << 20)))).alias("tail")).where("stem <> ''")
    stems = parts.select("name", F.col("stem").alias("tail")).distinct()
    extended = tails.join(stems, ["name", "tail"]).groupBy("tag").agg(F.min(F.length("tail")).alias("short"))
    prefix = F.when(F.col("short") > 0, F.regexp_replace(F.left("stem", F.length("stem") - F.col("short")), "_+$", "")).otherwise("")
    own = F.filter("q", lambda x: ~F.array_contains(F.coalesce("common", F.array().cast("array<string>")), x))
    marked = parts.join(common, "name", "left").join(extended, "tag", "left").select("tag", "name", F.concat(F.when(F.coalesce(prefix, F.lit("")) != "", F.array(prefix)).otherwise(F.array().cast("array<string>")), own).alias("marks"))
    counts = marked.groupBy("name", F.size("marks").alias("n")).count().groupBy("name").agg(F.min("n").alias("plainest"), (F.min_by("count", "n") == 1).alias("sole"))
    return marked.join(counts, "name")


def disambiguate(names: DataFrame, chars: DataFrame, labels: DataFrame, conv: Converter | None = None, lang: str = "zh_hans", also: tuple[str, ...] = ("zh_hant",)) -> DataFrame:
    """Colliding names get their marks back as a suffix; the one plainest tag of a group stays bare.

    labels: (qualifier, label, priority), the least priority first; an unknown mark keeps its words.
    """
    members = names.where(filled(F.col(lang))).join(chars.select("tag").distinct(), "tag", "left_semi").select("tag", F.col(lang).alias("name"))
    renamed = marks(members).where((F.size("marks") > 0) & ~((F.size("marks") == F.col("plainest")) & F.col("sole")))
    known = labels.where(F.col("label").isNotNull()).groupBy("qualifier").agg(F.min_by("label", "priority").alias("label"))
    each = renamed.select("tag", F.posexplode("marks").alias("pos", "qualifier")).join(known, "qualifier", "left")
    word = F.coalesce("label", F.replace("qualifier", F.lit("_"), F.lit(" ")))
    joined = each.groupBy("tag").agg(F.array_sort(F.collect_list(F.struct("pos", word.alias("w")))).alias("l"))
    suffixes = joined.select("tag", F.concat(F.lit("（"), F.array_join(F.col("l.w"), "·"), F.lit("）")).alias("_suffix"))
    out = names.join(suffixes, "tag", "left")
    add = {lang: F.concat(F.col(lang), F.col("_suffix"))}
    for other in also:
        theirs = conv.taiwan(F.col("_suffix")) if conv and other == "zh_hant" else F.col("_suffix")
        add[other] = F.when(filled(F.col(other)), F.concat(F.col(other), theirs)).otherwise(F.col(other))
    return out.withColumns({c: F.when(F.col("_suffix").isNotNull(), v).otherwise(F.col(c)) for c, v in add.items()}).drop("_suffix")


def drop_wrong_script(names: DataFrame) -> DataFrame:
    """Korean without Hangul but with Han or kana, and Japanese with Hangul, become absent."""
    ko, ja = F.col("ko"), F.col("ja")
    return names.withColumns(
        {"ko": F.when(~(~ko.rlike(T.HANGUL_PLAIN) & (ko.rlike(T.HAN_PLAIN) | ko.rlike(T.KANA_PLAIN))), ko), "ja": F.when(~ja.rlike(T.HANGUL_PLAIN), ja)}
    )


def inherit_base_names(names: DataFrame, suffix: str = "_(cosplay)") -> DataFrame:
    """X with the suffix takes both Chinese names of X and a note."""
    note = suffix.strip("_()")
    base = names.select(F.concat("tag", F.lit(suffix)).alias("tag"), *[F.col(c).alias(f"_{c}") for c in CHINESE])
    joined = names.join(base, "tag", "left")
    return joined.withColumns({c: F.when(filled(F.col(f"_{c}")), F.concat(F.col(f"_{c}"), F.lit(f"（{note}）"))).otherwise(F.col(c)) for c in CHINESE}).drop(*[f"_{c}" for c in CHINESE])


def normalize_traditional(names: DataFrame, conv: Converter) -> DataFrame:
    """Taiwan's forms where the traditional name is a conversion of the simplified one, or is not traditional at all."""
    hans, hant = F.col("zh_hans"), F.col("zh_hant")
    redo = filled(hans) & filled(hant) & ((conv.traditional(hans) == hant) | ~conv.is_traditional(hant))
    return names.withColumn("zh_hant", F.when(redo, conv.taiwan(hans)).otherwise(hant))


def resolve_names(maps: list[DataFrame], general: DataFrame, supplement: DataFrame, rejected: DataFrame, manuals: list[DataFrame], copyrights: DataFrame, variants_zh: DataFrame, variants_ja: DataFrame, conv: Converter, wanted: DataFrame | None = None) -> DataFrame:
    """All layers folded in order; the order is the policy.

    Names are written between the passes that read them several times.
    """
    names = fill_layer(base_names(maps, wanted), only(general, wanted), conv)
    names = reject_layer(override_layer(names, only(supplement, wanted), conv), only(rejected, wanted))
    for layer in manuals:
        names = override_layer(names, only(layer, wanted), conv)
    names = written(names)
    chars = written(characters(names, copyrights, general))
    for lang, also, variants in (("zh_hans", ("zh_hant",), variants_zh), ("ja", (), variants_ja)):
        own = names.join(copyrights.select("tag").distinct(), "tag", "left_semi").where(filled(F.col(lang)))
        labels = own.select(F.col("tag").alias("qualifier"), F.col(lang).alias("label"), F.lit(0).alias("priority")).unionByName(variants.select("qualifier", "label", F.lit(1).alias("priority")))
        names = written(disambiguate(names, chars, labels, conv, lang, also))
    return finish_names(names, conv)


def finish_names(names: DataFrame, conv: Converter) -> DataFrame:
    """The passes after the layers: brackets, slugs, scripts, notes, glyphs, punctuation, traditional forms."""
    names = names.withColumns({c: T.normalize_slugs(T.repair_brackets(F.col(c))) for c in LANGS})
    names = inherit_base_names(drop_wrong_script(names))
    names = names.withColumns({c: T.full_width(conv.repair(F.col(c), c), c) for c in LANGS})
    return normalize_traditional(names, conv)


def slots(names: DataFrame) -> DataFrame:
    """Long form (tag, lang, value, status) of the slots that are named or rejected."""
    entries = F.array(*[F.struct(F.lit(c).alias("lang"), F.col(c).alias("value"), (F.lit(c in CHINESE) & F.col("rejected")).alias("no")) for c in LANGS])
    long = names.select("tag", F.explode(entries).alias("s")).select("tag", "s.*")
    return long.where(filled(F.col("value")) | F.col("no")).select("tag", "lang", F.when(filled(F.col("value")), F.col("value")).alias("value"), F.when(filled(F.col("value")), "named").otherwise("rejected").alias("status"))
