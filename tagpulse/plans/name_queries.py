"""Queries over names, search and review; each with its DuckDB SQL over the same fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.han import Converter, convert
from ..operators import cells as C
from ..operators import names as N
from ..operators import review as R
from ..operators import serving as V
from ..sources.readers import alias_pool, clean_picks, parse_layer
from ..sources.serving_store import write_keyed
from ..sources.shared import new_path
from ..sources.sinks import display_name_rows
from .fixture import PHRASES, STAGES, duck, spark_view

CONV = Converter(STAGES)


def spelled(spark: SparkSession, d: str) -> DataFrame:
    return spark_view(spark, d, "spelled")


def dim(spark: SparkSession, d: str) -> DataFrame:
    return C.tag_dim(spark_view(spark, d, "tags"), 0, excluded=None)


def t2s(x: str) -> str:
    return f"translate({x}, '會國學圖劍樂', '会国学图剑乐')"


def s2t(x: str) -> str:
    return f"translate({x}, '会国学图剑乐', '會國學圖劍樂')"


def jp2t(x: str) -> str:
    return f"translate({x}, '剣国学楽会', '劍國學樂會')"


def simplified(x: str) -> str:
    return f"({t2s(jp2t(x))} = {x})"


def traditional(x: str) -> str:
    return f"NOT ({t2s(x)} = {x} AND {s2t(x)} <> {x})"


HAN, KANA, HANGUL = T.HAN_NAME, T.KANA_NAME, T.HANGUL_BUCKET
HAN_LANG = lambda x: f"CASE WHEN {s2t(x)} <> {x} THEN 'zh_hans' WHEN {jp2t(x)} <> {x} THEN 'ja' ELSE 'zh_hant' END"
CLASSIFY = lambda x: f"CASE WHEN regexp_matches({x}, '{HANGUL}') THEN 'ko' WHEN regexp_matches({x}, '{KANA}') THEN 'ja' WHEN regexp_matches({x}, '{HAN}') THEN {HAN_LANG(x)} ELSE 'en' END"
SPELLINGS = "all_names AS (SELECT tag, k, unnest([hans, hant, jahan, kana, hangul, latin]) AS name FROM spelled)"


def _spellings(rows: DataFrame) -> DataFrame:
    """All spellings. A table of parts is small for its number of rows, so few tasks would read it: rows are dealt out first."""
    return rows.repartition("k").select("tag", "k", F.explode(F.array("hans", "hant", "jahan", "kana", "hangul", "latin")).alias("name"))


# --- text functions


def slug_functions(spark, d):
    slug = F.concat(F.col("tag"), F.lit("__(set_"), (F.col("k") % 7).cast("string"), F.lit(")"))
    x = F.col("slug")
    return spelled(spark, d).select(slug.alias("slug")).select(
        "slug", T.title_slug(x).alias("title"), T.strip_disambig(x).alias("bare"), T.character_en(x).alias("en"), F.array_join(T.qualifiers(x), ",").alias("qualifiers"), T.stem(x).alias("stem"),
        T.strip_trailing_bracket(F.concat(x, F.lit("(a)"))).alias("unbracketed"),
    )


def day_functions(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 9 == 0, "").otherwise("T10:00"))
    bad = F.when(F.col("o_orderkey") % 5 == 0, F.replace(text, F.lit("-"), F.lit("/"))).otherwise(text)
    days = orders.select("o_orderkey", T.strict_day(bad).alias("day"))
    return days.where("day is not null").select("o_orderkey", "day", T.epoch_month(F.col("day")).alias("epoch_month"), T.yyyymmdd(F.col("day")).alias("ymd"))


def script_class(spark, d):
    x = F.col("name")
    return _spellings(spelled(spark, d)).select("tag", "name", N.classify(x, CONV).alias("lang"), T.is_han_name(x).alias("han_name"), T.has_katakana(x).alias("katakana"), T.to_hiragana(x).alias("hiragana"))


PUNCTUATED = """marked AS (SELECT k, k % 7 AS kind, CASE k % 7 WHEN 0 THEN hans || ':' || hans WHEN 1 THEN hans || '!?' WHEN 2 THEN hans || '(' || hans || ')' WHEN 3 THEN hans || ' (abc)'
  WHEN 4 THEN hans || '・' || hans WHEN 5 THEN 'Re:' || hans ELSE hans || '(abc)' END AS raw,
  CASE k % 7 WHEN 0 THEN hans || '：' || hans WHEN 1 THEN hans || '！？' WHEN 2 THEN hans || '（' || hans || '）' WHEN 3 THEN hans || '（abc）' WHEN 4 THEN hans || '·' || hans WHEN 5 THEN 'Re:' || hans ELSE hans || '(abc)' END AS fixed FROM spelled)"""
BRACKETS = """marked AS (SELECT k, CASE k % 6 WHEN 0 THEN hans || '「' || hans || ')' WHEN 1 THEN hangul || '(' || hangul WHEN 2 THEN '(' || hans WHEN 3 THEN hans || '))' WHEN 4 THEN hangul || '_' || hangul ELSE latin || '_x' END AS raw,
  CASE k % 6 WHEN 0 THEN hans || '(' || hans || ')' WHEN 1 THEN hangul || '(' || hangul || ')' WHEN 2 THEN hans WHEN 3 THEN hans WHEN 4 THEN hangul || ' ' || hangul ELSE latin || '_x' END AS fixed FROM spelled)"""
ITERATED = """marked AS (SELECT k, CASE k % 3 WHEN 0 THEN hans || '々' WHEN 1 THEN '々' || hans ELSE hans || '々々' || latin END AS raw,
  CASE k % 3 WHEN 0 THEN hans || right(hans, 1) WHEN 1 THEN '々' || hans ELSE hans || repeat(right(hans, 1), 2) || latin END AS fixed FROM spelled)"""


def _raw(spark, d, text: str) -> DataFrame:
    """The raw column of one of the fixtures above."""
    source = text[text.index("(") + 1 : text.rindex(")")]
    return spark.sql(source.replace("FROM spelled", "FROM {spelled}"), spelled=spelled(spark, d)).select("k", "raw")


def punctuation(spark, d):
    return _raw(spark, d, PUNCTUATED).select("k", "raw", T.full_width(F.col("raw"), "zh_hans").alias("fixed"))


def brackets_and_slugs(spark, d):
    return _raw(spark, d, BRACKETS).select("k", "raw", T.normalize_slugs(T.repair_brackets(F.col("raw"))).alias("fixed"))


def iteration_mark(spark, d):
    return _raw(spark, d, ITERATED).select("k", "raw", T.expand_iteration(F.col("raw")).alias("fixed"))


def convert_text(spark, d):
    return spelled(spark, d).select("tag", convert(F.col("hans"), [PHRASES]).alias("phrases"), convert(F.concat(F.col("hans"), F.lit("剑乐"), F.col("hans")), [PHRASES], "剑乐").alias("guarded"), CONV.simplify(F.col("hant")).alias("simple"), CONV.taiwan(F.col("hans")).alias("taiwan"))


def glyph_repair(spark, d):
    x = F.col("name")
    rows = _spellings(spelled(spark, d)).where(T.is_han_name(x))
    return rows.select("tag", "name", CONV.is_simplified(x).alias("simple"), CONV.is_traditional(x).alias("trad"), CONV.repair(x, "zh_hans").alias("hans"), CONV.repair(x, "zh_hant").alias("hant"))


# --- buckets, picks, layers

WIKI = """wiki AS (SELECT tag AS title, k, CASE WHEN k % 13 = 0 THEN '[bad' ELSE '["' || kana || '", "' || hant || '", "' || hans || '", "' || hangul || '", " ' || latin || '", "' || kana || '"]' END AS other_names,
  CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END AS is_deleted FROM spelled)"""
BUCKETS = f"""positions AS (SELECT tag, k, unnest([{{'pos': 0, 'name': kana}}, {{'pos': 1, 'name': hant}}, {{'pos': 2, 'name': hans}}, {{'pos': 3, 'name': hangul}}, {{'pos': 4, 'name': latin}}]) AS p FROM spelled WHERE k % 13 <> 0 AND k % 11 <> 0),
buckets AS (SELECT tag, {CLASSIFY('p.name')} AS lang, min(p.pos)::INT AS pos, p.name AS name FROM positions JOIN tags ON tags.name = tag WHERE post_count > 0 AND category IN (3, 4) GROUP BY ALL)"""


def wiki(spark, d) -> DataFrame:
    source = WIKI[WIKI.index("(") + 1 : WIKI.rindex(")")]
    return spark.sql(source.replace("FROM spelled", "FROM {spelled}"), spelled=spelled(spark, d))


def _buckets(spark, d) -> DataFrame:
    tags = spark_view(spark, d, "tags").where(F.col("category").isin(3, 4))
    return N.bucket_aliases(N.wiki_names(tags, wiki(spark, d)), CONV)


def bucket_aliases(spark, d):
    return _buckets(spark, d)


def pick_names(spark, d):
    b = _buckets(spark, d)
    return N.pick(b).join(N.pick(b, "shortest").withColumnRenamed("name", "shortest"), ["tag", "lang"])


def ambiguous_tags(spark, d):
    return R.ambiguous(_buckets(spark, d))


def build_map(spark, d):
    """Character maps of the buckets, an official entry for every tenth tag."""
    official = spelled(spark, d).where("k % 10 = 4").select("tag", F.col("hans").alias("zh_hans"), F.lit(None).cast("string").alias("zh_hant"), F.lit("").alias("ja"), F.col("latin").alias("en"), F.lit(None).cast("string").alias("ko"))
    out = N.build_map(_buckets(spark, d), N.pick_character, CONV, official, en_override=T.character_en)
    return out.select("tag", "zh_hans", "zh_hant", "ja", "en", "ko")


def alias_pools(spark, d):
    return alias_pool(wiki(spark, d)).select("tag", F.array_join("names", "|").alias("names"))


def official_picks(spark, d):
    """Non-empty strings of four languages out of batch answers."""
    rows = spelled(spark, d).select("tag", F.create_map(F.lit("ja"), F.col("kana"), F.lit("ko"), F.when(F.col("k") % 2 == 0, F.col("hangul")).otherwise(" "), F.lit("en"), F.col("latin"), F.lit("zh_hans"), F.when(F.col("k") % 3 == 0, F.col("hans"))).alias("picks"))
    return clean_picks(rows).select("tag", F.explode("picks").alias("lang", "name"))


LAYERS = {
    "base": "SELECT tag, lang, name FROM (SELECT tag, 'zh_hans' AS lang, CASE WHEN k % 4 = 0 THEN hans END AS name FROM {spelled} UNION ALL SELECT tag, 'zh_hant', CASE WHEN k % 8 = 0 THEN hant END FROM {spelled} UNION ALL SELECT tag, 'ja', kana FROM {spelled} UNION ALL SELECT tag, 'en', latin FROM {spelled}) x",
    "second": "SELECT tag, 'ja' AS lang, hangul AS name FROM {spelled} UNION ALL SELECT tag, 'ko', hangul FROM {spelled}",
    "general": "SELECT tag, hans || '木' AS v FROM {spelled} WHERE k % 3 = 0",
    "supplement": "SELECT tag, CASE WHEN k % 2 = 0 THEN hans || '火' ELSE '{{\"zh_hant\":\"' || hant || '水\"}}' END AS v FROM {spelled} WHERE k % 5 = 0",
    "rejected": "SELECT tag FROM {spelled} WHERE k % 7 = 0",
    "manual": "SELECT tag, hans || '山' AS v FROM {spelled} WHERE k % 35 = 0",
}


def _layer(spark, d, name: str) -> DataFrame:
    return spark.sql(LAYERS[name], spelled=spelled(spark, d))


def folded(spark, d) -> DataFrame:
    names = N.base_names([_layer(spark, d, "base"), _layer(spark, d, "second")])
    names = N.fill_layer(names, parse_layer(_layer(spark, d, "general")), CONV)
    names = N.override_layer(names, parse_layer(_layer(spark, d, "supplement")), CONV)
    names = N.reject_layer(names, _layer(spark, d, "rejected"))
    return N.override_layer(names, parse_layer(_layer(spark, d, "manual")), CONV)


def layer_fold(spark, d):
    return folded(spark, d).select("tag", *N.LANGS, "rejected")


def name_slots(spark, d):
    return N.slots(folded(spark, d))


def display_names(spark, d):
    """The slots as JSON, null where rejected."""
    return display_name_rows(folded(spark, d))


FOLD = f"""s1 AS (SELECT tag, k, hans, hant AS hant_full, kana, latin, hangul, CASE WHEN k % 4 = 0 THEN hans END AS h, CASE WHEN k % 8 = 0 THEN hant END AS t FROM spelled),
s2 AS (SELECT * REPLACE (CASE WHEN k % 3 = 0 AND h IS NULL THEN hans || '木' ELSE h END AS h, CASE WHEN k % 3 = 0 AND h IS NULL AND t IS NULL THEN {s2t("hans || '木'")} ELSE t END AS t) FROM s1),
s3 AS (SELECT * REPLACE (CASE WHEN k % 10 = 0 THEN hans || '火' ELSE h END AS h,
  CASE WHEN k % 10 = 0 AND (t IS NULL OR (h IS NOT NULL AND {t2s('t')} = h)) THEN {s2t("hans || '火'")} WHEN k % 5 = 0 AND k % 2 = 1 THEN hant_full || '水' ELSE t END AS t) FROM s2),
s4 AS (SELECT *, k % 7 = 0 AS rejected FROM (SELECT * REPLACE (CASE WHEN k % 7 <> 0 THEN h END AS h, CASE WHEN k % 7 <> 0 THEN t END AS t) FROM s3)),
s5 AS (SELECT * REPLACE (CASE WHEN k % 35 = 0 THEN hans || '山' ELSE h END AS h, CASE WHEN k % 35 = 0 THEN {s2t("hans || '山'")} ELSE t END AS t) FROM s4),
folded AS (SELECT tag, h AS zh_hans, t AS zh_hant, kana AS ja, latin AS en, hangul AS ko, rejected FROM s5)"""
SLOTS = """slots AS (SELECT tag, s.lang AS lang, s.value AS value, CASE WHEN s.value IS NOT NULL THEN 'named' ELSE 'rejected' END AS status FROM (
  SELECT tag, rejected, unnest([{'lang': 'zh_hans', 'value': zh_hans}, {'lang': 'zh_hant', 'value': zh_hant}, {'lang': 'ja', 'value': ja}, {'lang': 'en', 'value': en}, {'lang': 'ko', 'value': ko}]) AS s FROM folded)
  WHERE s.value IS NOT NULL OR (rejected AND s.lang IN ('zh_hans', 'zh_hant')))"""
GROUPED = """members AS (SELECT CASE k % 4 WHEN 3 THEN 'male_c' ELSE 'c' END || (k // 4)::VARCHAR || CASE k % 4 WHEN 1 THEN '_(x_y)_(of)' WHEN 2 THEN '_(set)_(of)' ELSE '_(of)' END AS tag, translate((k // 4)::VARCHAR, '0123456789', '会国学图剑乐山水火木') AS name, k % 4 AS kind,
  count(*) OVER (PARTITION BY k // 4) AS n FROM spelled)"""


def _groups(spark, d) -> DataFrame:
    k4 = F.floor(F.col("k") / 4).cast("string")
    kind = F.col("k") % 4
    tag = F.concat(F.when(kind == 3, "male_c").otherwise("c"), k4, F.when(kind == 1, "_(x_y)_(of)").when(kind == 2, "_(set)_(of)").otherwise("_(of)"))
    name = F.translate(k4, "0123456789", "会国学图剑乐山水火木")
    return spelled(spark, d).select(tag.alias("tag"), name.alias("zh_hans"), CONV.traditional(name).alias("zh_hant"), F.lit(None).cast("string").alias("ja"), F.lit(None).cast("string").alias("en"), F.lit(None).cast("string").alias("ko"), F.lit(False).alias("rejected"))


def disambiguate(spark, d):
    names = _groups(spark, d)
    labels = spark.range(1).select(F.lit("set").alias("qualifier"), F.lit("国剑").alias("label"), F.lit(1).alias("priority"))
    return N.disambiguate(names, names.select("tag"), labels, CONV).select("tag", "zh_hans", "zh_hant")


def inherited_names(spark, d):
    names = folded(spark, d)
    dressed = names.where(F.col("tag").rlike("[05]$")).withColumn("tag", F.concat("tag", F.lit("_(cosplay)"))).withColumn("zh_hans", F.lit("会")).withColumn("zh_hant", F.lit(None).cast("string"))
    return N.inherit_base_names(names.unionByName(dressed)).where("tag like '%cosplay%'").select("tag", "zh_hans", "zh_hant")


def wrong_script(spark, d):
    rows = spelled(spark, d).select("tag", F.when(F.col("k") % 2 == 0, F.col("hans")).otherwise(F.col("hangul")).alias("ko"), F.when(F.col("k") % 3 == 0, F.col("hangul")).otherwise(F.col("kana")).alias("ja"))
    return N.drop_wrong_script(rows)


def finished_names(spark, d):
    """All passes after the layers."""
    return N.finish_names(folded(spark, d), CONV).select("tag", "zh_hans", "zh_hant", "ja", "en", "ko")


# --- serving and search


def _pool(spark, d) -> DataFrame:
    return spelled(spark, d).where("k % 2 = 0").select("tag", F.array("kana", "hangul", F.upper("tag"), F.upper("latin"), F.concat("latin", F.lit(" too"))).alias("names"))


def names_list(spark, d):
    return V.names_list(dim(spark, d), V.fill_chinese(folded(spark, d), CONV), _pool(spark, d)).select("tag", "pos", "lang", "name")


LISTED = f"""filled AS (SELECT tag, CASE WHEN zh_hant IS NOT NULL AND zh_hans IS NULL THEN {t2s('zh_hant')} ELSE zh_hans END AS zh_hans, CASE WHEN zh_hans IS NOT NULL AND zh_hant IS NULL THEN {s2t('zh_hans')} ELSE zh_hant END AS zh_hant, ja, en, ko FROM folded),
entries AS (SELECT tag, pos, lang, name FROM (
  SELECT tag, unnest([0, 1, 2, 3, 4]) AS pos, unnest(['zh_hans', 'zh_hant', 'ja', 'en', 'ko']) AS lang, unnest([zh_hans, zh_hant, ja, en, ko]) AS name FROM filled
  UNION ALL SELECT tag, unnest([5, 6, 7, 8, 9]), NULL, unnest([kana, hangul, upper(tag), upper(latin), latin || ' too']) FROM spelled WHERE k % 2 = 0) WHERE name IS NOT NULL),
listed AS (SELECT tag, pos, lang, name FROM (SELECT *, min(pos) OVER (PARTITION BY tag, lower(name)) AS first_pos FROM entries) WHERE lang IS NOT NULL OR (pos = first_pos AND lower(name) <> lower(tag)))"""
HIRA = "translate(name, 'アイウエオカキクケコ', 'あいうえおかきくけこ')"
TERMS = f"""spellings AS (SELECT tag, pos, unnest([0, 1, 2, 3]) AS v, unnest([name, CASE WHEN regexp_matches(name, '[ァ-ヶ]') THEN {HIRA} END, CASE WHEN regexp_matches(name, '{HAN}') AND NOT regexp_matches(name, '{KANA}') THEN {t2s('name')} END,
  CASE WHEN regexp_matches(name, '{HAN}') AND NOT regexp_matches(name, '{KANA}') THEN {s2t('name')} END]) AS term FROM listed),
ordered AS (SELECT tag, lower(term) AS term, min(pos * 4 + v) AS place FROM (SELECT * FROM spellings UNION ALL SELECT tag, -1, 0, tag FROM spelled) WHERE term IS NOT NULL AND term <> '' GROUP BY ALL),
search_rows AS (SELECT tag, list(term ORDER BY place) AS terms FROM ordered GROUP BY tag)"""


def _search_rows(spark, d) -> DataFrame:
    x = dim(spark, d)
    return V.search_rows(x, V.names_list(x, V.fill_chinese(folded(spark, d), CONV), _pool(spark, d)), CONV)


def search_terms(spark, d):
    return _search_rows(spark, d).select("tag", F.array_join("terms", "|").alias("terms"))


def search_one(spark, d):
    return V.search(_search_rows(spark, d), "あい", 15)


def exact_tag(spark, d):
    """A look-up in a stored table that is clustered by name."""
    path = new_path(spark, "dim")
    write_keyed(dim(spark, d), path, ["name"])
    return V.find(spark.read.parquet(path), "part_17").select("tag_id", "name", "post_count")


def asked(spark, d) -> DataFrame:
    """The query set of a search: every row whose key is divisible by 20."""
    return spelled(spark, d).where("k % 20 = 0").select(F.explode(F.array(F.concat(F.lit("RT_"), F.col("k").cast("string")), F.substring("hant", 1, 3))).alias("query"))


def search_many(spark, d):
    return V.search_many(_search_rows(spark, d), asked(spark, d))


def search_many_whole(spark, d):
    return search_many(spark, d)


def display_name(spark, d):
    return V.display(folded(spark, d), "zh_hans")


def language_coverage(spark, d):
    return V.language_coverage(N.slots(folded(spark, d)))


def category_coverage(spark, d):
    out = V.category_coverage(dim(spark, d), folded(spark, d), often=30)
    return out.withColumns({c: F.round(c, 6) for c in ("named_share", "post_share", "often_share")})


def serving_stats(spark, d):
    return V.serving_stats(dim(spark, d), folded(spark, d).where("en like '%7%'"), _pool(spark, d))


# --- review


def _answers(spark, d) -> DataFrame:
    kind = F.col("k") % 8
    value = F.when(kind == 0, F.col("hans")).when(kind == 1, F.lit("  ")).when(kind == 2, F.col("latin")).when(kind == 3, F.concat("kana", "hans")).when(kind == 4, F.concat("hant", F.lit("會"))).when(kind == 5, F.repeat("hans", 70))
    value = value.when(kind == 6, F.translate((F.col("k") / 16).cast("int").cast("string"), "0123456789", "会国学图剑乐山水火木")).otherwise(F.concat(F.lit(" "), F.col("hans"), F.lit("山")))
    return spelled(spark, d).select("tag", "k", value.alias("value"), F.when(F.col("k") % 16 == 0, F.col("hans")).alias("current_zh"))


ANSWERS = """answers AS (SELECT tag, k, CASE k % 8 WHEN 0 THEN hans WHEN 1 THEN '  ' WHEN 2 THEN latin WHEN 3 THEN kana || hans WHEN 4 THEN hant || '會' WHEN 5 THEN repeat(hans, 70)
  WHEN 6 THEN translate((k // 16)::VARCHAR, '0123456789', '会国学图剑乐山水火木') ELSE ' ' || hans || '山' END AS value, CASE WHEN k % 16 = 0 THEN hans END AS current_zh FROM spelled)"""
VERDICT = f"""judged AS (SELECT tag, trim(value) AS value, CASE WHEN k % 10 <> 9 THEN current_zh END AS current_zh, CASE WHEN k % 10 = 9 THEN 'unknown-tag' WHEN trim(value) = '' THEN 'empty' WHEN trim(value) = current_zh THEN 'confirmed'
  WHEN length(trim(value)) > 60 THEN 'too-long' WHEN NOT regexp_matches(value, '{HAN}') THEN 'no-han' WHEN regexp_matches(value, '{KANA}') THEN 'contains-kana' WHEN NOT {simplified('trim(value)')} THEN 'not-simplified' ELSE 'accepted' END AS verdict FROM answers)"""


def _judged(spark, d) -> DataFrame:
    a = _answers(spark, d)
    return R.judge(a, a.where("k % 10 <> 9"), CONV, review=True)


def judge_answers(spark, d):
    return _judged(spark, d)


def confirmation_rate(spark, d):
    return R.confirmation_rate(_judged(spark, d))


def reason_report(spark, d):
    return R.reason_report(_judged(spark, d), "verdict")


def _existing(spark, d) -> DataFrame:
    return spelled(spark, d).where("k % 3 = 0").select("tag", F.concat("hans", F.lit("水")).alias("value"))


def merge_answers(spark, d):
    a = _answers(spark, d)
    manual = spelled(spark, d).where("k % 20 = 1").select("tag", F.concat("hans", F.lit("火")).alias("value"))
    return R.merge_answers(a, a.where("k % 10 <> 9"), manual, _existing(spark, d), CONV)


def new_collisions(spark, d):
    a = _answers(spark, d).where("k % 8 in (0, 6)")
    return R.new_collisions(a.select("tag", "value"), a.select("tag", "current_zh"), _existing(spark, d))


def shared_values(spark, d):
    return R.shared_values(_groups(spark, d).select("tag", F.col("zh_hans").alias("value")))


PROPOSALS = """proposals AS (SELECT tag, round, 'fix' || round::VARCHAR || '.json' AS file, k, CASE WHEN round = 1 THEN CASE k % 6 WHEN 0 THEN hans WHEN 1 THEN '' WHEN 2 THEN hant || '會' ELSE hans || '山' END ELSE hans || '水' END AS value
  FROM spelled, (SELECT unnest([1, 2]) AS round) r WHERE round = 1 OR k % 4 = 0)"""
PROPOSED = f"""checked AS (SELECT p.tag, round, file, p.value, CASE WHEN p.k % 9 = 0 THEN 'not in a shard' WHEN category NOT IN (0, 3, 4) THEN 'wrong category' WHEN p.value = '' THEN 'empty' WHEN p.value = hans AND p.k % 2 = 0 THEN 'unchanged' WHEN NOT {simplified('p.value')} THEN 'not simplified' END AS reason
  FROM proposals p JOIN tags ON tags.name = p.tag JOIN spelled s ON s.tag = p.tag),
ranked AS (SELECT *, lag(value) OVER (PARTITION BY tag ORDER BY round DESC) AS later FROM checked WHERE reason IS NULL)"""


def _proposals(spark, d) -> DataFrame:
    kind = F.col("k") % 6
    first = F.when(kind == 0, F.col("hans")).when(kind == 1, "").when(kind == 2, F.concat("hant", F.lit("會"))).otherwise(F.concat("hans", F.lit("山")))
    rows = spelled(spark, d)
    one = rows.select("tag", F.lit(1).alias("round"), F.lit("fix1.json").alias("file"), first.alias("value"))
    return one.unionByName(rows.where("k % 4 = 0").select("tag", F.lit(2).alias("round"), F.lit("fix2.json").alias("file"), F.concat("hans", F.lit("水")).alias("value")))


def judge_proposals(spark, d):
    rows = spelled(spark, d)
    current = rows.where("k % 2 = 0").select("tag", F.col("hans").alias("value"))
    return R.judge_proposals(_proposals(spark, d), rows.where("k % 9 <> 0").select("tag"), spark_view(spark, d, "tags"), current, CONV, (0, 3, 4))


def strip_qualifier(spark, d):
    kind = F.col("k") % 3
    value = F.concat("hans", F.when(kind == 0, "（泳装）").when(kind == 1, "（泳装·国）").otherwise("（铁血）"))
    labels = F.array(F.lit("泳装"), F.when(F.col("k") % 2 == 0, "国").otherwise("学"))
    return spelled(spark, d).select("tag", R.strip_qualifier(value, labels).alias("value"))


def format_warnings(spark, d):
    kind = F.col("k") % 4
    tag = F.when(kind == 0, F.concat(F.lit("bad_"), "tag", F.lit("_id"))).when(kind == 1, F.concat("tag", F.lit("_pull"))).when(kind == 2, F.concat("tag", F.lit("_censor"))).otherwise(F.lit("leg_lift"))
    value = F.when(F.col("k") % 3 == 0, F.concat(F.lit("失效"), "hans")).when(F.col("k") % 3 == 1, F.concat(F.lit("拉"), "hans")).otherwise(F.concat("hans", F.lit("打码")))
    return R.format_warnings(spelled(spark, d).select(tag.alias("tag"), value.alias("value")))


def merge_rejections(spark, d):
    rows = spelled(spark, d)
    return R.merge_rejections(rows.where("k % 2 = 0"), rows.where("k % 3 <> 0"), spark_view(spark, d, "tags"), rows.where("k % 5 = 0"), rows.where("k % 7 <> 0").select("tag", F.col("hans").alias("legacy_zh")))


def hand_conflicts(spark, d):
    """Hand-fixed values that proposals would change; and the layer with the hand's word kept."""
    hand = _existing(spark, d)
    new = spelled(spark, d).where("k % 2 = 0").select("tag", F.concat("hans", F.when(F.col("k") % 4 == 0, "水").otherwise("火")).alias("value"))
    kept = R.merge_layer(hand, new, prefer="existing")
    return kept.join(R.hand_conflicts(hand, new).select("tag", "proposed"), "tag", "left")


def review_targets(spark, d):
    names = folded(spark, d)
    done = R.reviewed([parse_layer(_layer(spark, d, "supplement")), parse_layer(_layer(spark, d, "manual"))])
    args = (dim(spark, d), names, done, _pool(spark, d))
    fill, review = (R.review_targets(*args, mode, floor=10).withColumn("mode", F.lit(mode)) for mode in ("fill", "review"))
    both = fill.unionByName(review)
    return both.select("mode", "tag", "post_count", "anchors.category", F.array_join("anchors.aliases", "|").alias("aliases"), "anchors.current_zh")


def review_batches(spark, d):
    return R.numbered(dim(spark, d).where("category in (3, 4)").select("name", "post_count"), [F.desc("post_count"), F.col("name")], 50)


def most_used(spark, d):
    return R.most_used(dim(spark, d).select("name", "post_count"), 25)


def missing_batches(spark, d):
    expected = spelled(spark, d).select((F.col("k") % 100).cast("int").alias("batch"))
    done = spelled(spark, d).where("k % 100 < 90").select((F.col("k") % 100).cast("int").alias("batch"), (F.col("k") % 10 == 0).alias("corrupt"))
    return R.missing_batches(expected, done)


def accept_translations(spark, d):
    value = F.when(F.col("k") % 4 == 0, F.col("hans")).when(F.col("k") % 4 == 1, F.col("tag")).when(F.col("k") % 4 == 2, F.lit(" ")).otherwise(F.col("latin"))
    return R.accept_translations(R.in_categories(dim(spark, d), (0, 5)).select(F.col("name").alias("tag")).join(spelled(spark, d).select("tag", value.alias("name")), "tag"))


QUERIES = {f.__name__: f for f in (
    slug_functions, day_functions, script_class, punctuation, brackets_and_slugs, iteration_mark, convert_text, glyph_repair, bucket_aliases, pick_names, ambiguous_tags, build_map, alias_pools, official_picks, layer_fold, name_slots, display_names, disambiguate,
    inherited_names, wrong_script, finished_names, names_list, search_terms, search_one, exact_tag, search_many, search_many_whole, display_name, language_coverage, category_coverage, serving_stats, judge_answers, confirmation_rate, reason_report, merge_answers, new_collisions,
    shared_values, judge_proposals, strip_qualifier, format_warnings, merge_rejections, hand_conflicts, review_targets, review_batches, most_used, missing_batches, accept_translations,
)}


def _sql(final: str, *parts: str, views: tuple[str, ...] = ("spelled",)) -> str:
    return duck(", ".join(parts or ("x AS (SELECT 1)",)) + " " + final, *views)


BOTH = ("spelled", "tags")
ORACLE_SQL = {
    "slug_functions": _sql(
        r"""SELECT slug, array_to_string(list_transform(string_split(replace(slug, '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title, regexp_replace(slug, '_\([^()]*\)$', '') AS bare,
        array_to_string(list_transform(string_split(replace(regexp_replace(slug, '_\([^()]*\)$', ''), '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS en, array_to_string(regexp_extract_all(slug, '\(([^()]+)\)', 1), ',') AS qualifiers,
        trim(replace(regexp_replace(slug, '\([^()]+\)', '', 'g'), '__', '_'), '_') AS stem, slug AS unbracketed FROM slugs""",
        "slugs AS (SELECT tag || '__(set_' || (k % 7)::VARCHAR || ')' AS slug FROM spelled)"),
    "day_functions": "SELECT o_orderkey, day, (year(day) * 12 + month(day) - 1)::INT AS epoch_month, strftime(day, '%Y%m%d')::INT AS ymd FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 5 <> 0)",
    "script_class": _sql(f"SELECT tag, name, {CLASSIFY('name')} AS lang, regexp_matches(name, '{HAN}') AS han_name, regexp_matches(name, '[ァ-ヶ]') AS katakana, {HIRA} AS hiragana FROM all_names", SPELLINGS),
    "punctuation": _sql("SELECT k, raw, fixed FROM marked", PUNCTUATED),
    "brackets_and_slugs": _sql("SELECT k, raw, fixed FROM marked", BRACKETS),
    "iteration_mark": _sql("SELECT k, raw, fixed FROM marked", ITERATED),
    "convert_text": _sql(f"SELECT tag, translate(replace(hans, '会国', '協和'), '会国', '會國') AS phrases, translate(replace(hans, '会国', '協和'), '会国', '會國') || '剑乐' || translate(replace(hans, '会国', '協和'), '会国', '會國') AS guarded, {t2s('hant')} AS simple, {s2t('hans')} AS taiwan FROM spelled"),
    "glyph_repair": _sql(f"SELECT tag, name, {simplified('name')} AS simple, {traditional('name')} AS trad, {t2s(jp2t('name'))} AS hans, CASE WHEN {traditional('name')} THEN name ELSE {jp2t('name')} END AS hant FROM all_names WHERE regexp_matches(name, '{HAN}')", SPELLINGS),
    "bucket_aliases": _sql("SELECT * FROM buckets", BUCKETS, views=BOTH),
    "pick_names": _sql("SELECT tag, lang, arg_min(name, pos) AS name, arg_min(name, length(name) * 10 + pos) AS shortest FROM buckets GROUP BY tag, lang", BUCKETS, views=BOTH),
    "ambiguous_tags": _sql("SELECT DISTINCT tag FROM (SELECT tag, lang FROM buckets WHERE lang <> 'en' GROUP BY ALL HAVING count(*) > 1)", BUCKETS, views=BOTH),
    "build_map": _sql(
        """SELECT tag, hans AS zh_hans, hant AS zh_hant, CASE WHEN k % 10 = 4 THEN translate(hant, '劍國學樂會', '剣国学楽会') ELSE kana END AS ja, 'Part ' || k::VARCHAR AS en, CASE WHEN k % 10 <> 4 THEN hangul END AS ko
        FROM spelled JOIN tags ON name = tag WHERE k % 13 <> 0 AND k % 11 <> 0 AND post_count > 0 AND category IN (3, 4)""", views=BOTH),
    "alias_pools": _sql("SELECT tag, kana || '|' || hant || '|' || hans || '|' || hangul || '| ' || latin || '|' || kana AS names FROM spelled WHERE k % 13 <> 0 AND k % 11 <> 0"),
    "official_picks": _sql("SELECT tag, 'ja' AS lang, kana AS name FROM spelled UNION ALL SELECT tag, 'ko', hangul FROM spelled WHERE k % 2 = 0 UNION ALL SELECT tag, 'zh_hans', hans FROM spelled WHERE k % 3 = 0"),
    "layer_fold": _sql("SELECT * FROM folded", FOLD),
    "name_slots": _sql("SELECT * FROM slots", FOLD, SLOTS),
    "display_names": _sql("""SELECT tag, '{' || string_agg('"' || lang || '":' || coalesce('"' || value || '"', 'null'), ',' ORDER BY lang) || '}' AS names FROM slots GROUP BY tag""", FOLD, SLOTS),
    "disambiguate": _sql(
        f"""SELECT tag, name || suffix AS zh_hans, {s2t("name || suffix")} AS zh_hant FROM (SELECT tag, name, CASE WHEN n = 1 OR kind = 0 THEN '' WHEN kind = 1 THEN '（x y）' WHEN kind = 2 THEN '（国剑）' ELSE '（male）' END AS suffix FROM members)""", GROUPED),
    "inherited_names": _sql("SELECT tag || '_(cosplay)' AS tag, coalesce(zh_hans || '（cosplay）', '会') AS zh_hans, zh_hant || '（cosplay）' AS zh_hant FROM folded WHERE regexp_matches(tag, '[05]$')", FOLD),
    "wrong_script": _sql("SELECT tag, CASE WHEN k % 2 = 1 THEN hangul END AS ko, CASE WHEN k % 3 <> 0 THEN kana END AS ja FROM spelled"),
    "finished_names": _sql(f"SELECT tag, zh_hans, CASE WHEN zh_hans IS NOT NULL AND zh_hant IS NOT NULL AND ({s2t('zh_hans')} = zh_hant OR NOT ({traditional('zh_hant')})) THEN {s2t('zh_hans')} ELSE zh_hant END AS zh_hant, ja, en, ko FROM folded", FOLD),
    "names_list": _sql("SELECT * FROM listed", FOLD, LISTED),
    "search_terms": _sql("SELECT tag, array_to_string(terms, '|') AS terms FROM search_rows", FOLD, LISTED, TERMS),
    "search_one": _sql("SELECT tag, list_filter(terms, lambda t: contains(t, 'あい'))[1] AS hit FROM search_rows WHERE len(list_filter(terms, lambda t: contains(t, 'あい'))) > 0 ORDER BY tag LIMIT 15", FOLD, LISTED, TERMS),
    "exact_tag": _sql("SELECT id AS tag_id, name, post_count::BIGINT AS post_count FROM tags WHERE name = 'part_17'", views=("tags",)),
    "search_many": _sql("SELECT DISTINCT query, tag FROM asked JOIN ordered ON contains(term, lower(query)) WHERE query <> ''", FOLD, LISTED, TERMS, "asked AS (SELECT unnest(['RT_' || k::VARCHAR, substr(hant, 1, 3)]) AS query FROM spelled WHERE k % 20 = 0)"),
    "display_name": _sql("SELECT tag, coalesce(zh_hans, tag) AS shown FROM folded", FOLD),
    "language_coverage": _sql("SELECT lang, count(*) AS tags FROM slots WHERE value IS NOT NULL GROUP BY lang", FOLD, SLOTS),
    "category_coverage": _sql(
        """SELECT category::TINYINT AS category, count(*) AS tags, round(avg((zh_hans IS NOT NULL)::INT), 6) AS named_share, round(sum(CASE WHEN zh_hans IS NOT NULL THEN post_count ELSE 0 END) / sum(post_count), 6) AS post_share,
        round(avg((zh_hans IS NOT NULL)::INT) FILTER (post_count >= 30), 6) AS often_share FROM tags JOIN folded ON tag = name GROUP BY category""", FOLD, views=BOTH),
    "serving_stats": _sql("SELECT count(*) AS tags, count(*) FILTER (latin LIKE '%7%') AS displayable, count(*) FILTER (latin LIKE '%7%' OR k % 2 = 0) AS translated FROM spelled"),
    "judge_answers": _sql("SELECT * FROM judged", ANSWERS, VERDICT),
    "confirmation_rate": _sql("SELECT count(*) FILTER (verdict = 'confirmed') AS confirmed, count(*) AS judged, (count(*) FILTER (verdict = 'confirmed') * 100 // greatest(count(*), 1))::BIGINT AS rate FROM judged WHERE verdict <> 'unknown-tag'", ANSWERS, VERDICT),
    "reason_report": _sql("SELECT verdict, count(*) AS n, array_to_string(list(tag ORDER BY tag)[:6], ',') AS samples FROM judged GROUP BY verdict", ANSWERS, VERDICT),
    "merge_answers": _sql(
        f"""SELECT tag, value FROM (SELECT s.tag, CASE WHEN s.k % 10 <> 9 AND s.k % 20 = 1 THEN hans || '火' WHEN verdict IN ('accepted', 'confirmed') THEN j.value WHEN s.k % 3 = 0 THEN hans || '水' END AS value
        FROM spelled s JOIN judged j ON j.tag = s.tag) WHERE value IS NOT NULL""", ANSWERS, VERDICT),
    "new_collisions": _sql(
        """SELECT a.tag, a.value, (SELECT count(*) FROM final f WHERE f.value = a.value AND f.tag <> a.tag) AS others FROM picked a
        WHERE EXISTS (SELECT 1 FROM final f WHERE f.value = a.value AND f.tag <> a.tag) AND a.value IS DISTINCT FROM a.current_zh AND NOT (a.current_zh IS NOT NULL AND EXISTS (SELECT 1 FROM final f WHERE f.value = a.current_zh AND f.tag <> a.tag))""",
        ANSWERS, "picked AS (SELECT * FROM answers WHERE k % 8 IN (0, 6))", "final AS (SELECT tag, value FROM picked UNION ALL SELECT tag, hans || '水' FROM spelled WHERE k % 3 = 0 AND tag NOT IN (SELECT tag FROM picked))"),
    "shared_values": _sql("SELECT name AS value, count(*) AS tags FROM members GROUP BY name HAVING count(*) > 1", GROUPED),
    "judge_proposals": _sql("SELECT tag, round, file, value, reason FROM checked WHERE reason IS NOT NULL UNION ALL SELECT tag, round, file, value, CASE WHEN later IS NOT NULL AND later <> value THEN 'superseded' WHEN later IS NOT NULL THEN 'repeated' END FROM ranked", PROPOSALS, PROPOSED, views=BOTH),
    "strip_qualifier": _sql("SELECT tag, CASE WHEN k % 3 = 0 OR (k % 3 = 1 AND k % 2 = 0) THEN hans WHEN k % 3 = 1 THEN hans || '（泳装·国）' ELSE hans || '（铁血）' END AS value FROM spelled"),
    "format_warnings": _sql(
        """SELECT tag, value, rule FROM (SELECT k, CASE k % 4 WHEN 0 THEN 'bad_' || tag || '_id' WHEN 1 THEN tag || '_pull' WHEN 2 THEN tag || '_censor' ELSE 'leg_lift' END AS tag, CASE k % 3 WHEN 0 THEN '失效' || hans WHEN 1 THEN '拉' || hans ELSE hans || '打码' END AS value,
        CASE WHEN k % 4 = 0 AND k % 3 <> 0 THEN 'bad_*_id' WHEN k % 4 = 1 AND k % 3 <> 1 THEN '*_pull' WHEN k % 4 = 2 AND k % 3 <> 2 THEN '*_censor' END AS rule FROM spelled) WHERE rule IS NOT NULL"""),
    "merge_rejections": _sql(
        """SELECT tag, CASE WHEN k % 7 <> 0 THEN hans END AS legacy_zh, CASE WHEN k % 3 = 0 THEN 'not in a shard' WHEN category NOT IN (0, 3, 5) THEN 'wrong category' WHEN k % 5 = 0 THEN 'already rejected' WHEN k % 7 = 0 THEN 'no rejected value' END AS reason
        FROM spelled JOIN tags ON name = tag WHERE k % 2 = 0""", views=BOTH),
    "hand_conflicts": _sql("SELECT tag, CASE WHEN k % 3 = 0 THEN hans || '水' WHEN k % 4 = 0 THEN hans || '水' ELSE hans || '火' END AS value, CASE WHEN k % 3 = 0 AND k % 2 = 0 AND k % 4 <> 0 THEN hans || '火' END AS proposed FROM spelled WHERE k % 3 = 0 OR k % 2 = 0"),
    "review_targets": _sql(
        """SELECT CASE WHEN zh_hans IS NULL THEN 'fill' ELSE 'review' END AS mode, f.tag, post_count::BIGINT AS post_count, CASE category WHEN 3 THEN 'copyright' ELSE 'character' END AS category,
        CASE WHEN k % 2 = 0 THEN kana || '|' || hangul || '|' || upper(s.tag) || '|' || upper(latin) || '|' || latin || ' too' END AS aliases, zh_hans AS current_zh
        FROM folded f JOIN spelled s ON s.tag = f.tag JOIN tags ON tags.name = f.tag WHERE category IN (3, 4) AND post_count >= 10 AND (zh_hans IS NULL OR k % 5 <> 0)""", FOLD, views=BOTH),
    "review_batches": _sql("SELECT name, post_count::BIGINT AS post_count, ((row_number() OVER (ORDER BY post_count DESC, name) - 1) // 50)::INT AS batch FROM tags WHERE category IN (3, 4)", views=("tags",)),
    "most_used": _sql("SELECT name, post_count::BIGINT AS post_count FROM tags ORDER BY post_count DESC, name LIMIT 25", views=("tags",)),
    "missing_batches": _sql("SELECT DISTINCT (k % 100)::INT AS batch FROM spelled WHERE k % 100 >= 90 OR k % 10 = 0"),
    "accept_translations": _sql(
        """SELECT tag, name, CASE WHEN name = '' THEN 'empty' WHEN name = tag THEN 'same-as-slug' WHEN k % 4 <> 0 THEN 'no-han' END AS reason FROM (
        SELECT tag, k, CASE k % 4 WHEN 0 THEN hans WHEN 1 THEN tag WHEN 2 THEN '' ELSE latin END AS name FROM spelled JOIN tags t ON t.name = spelled.tag WHERE category IN (0, 5))""", views=BOTH),
}
ORACLE_SQL["search_many_whole"] = ORACLE_SQL["search_many"]
