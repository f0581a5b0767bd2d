"""Queries through the readers and writers, and of whole chains; each with its DuckDB SQL over the same fixture.

Files are written from the fixture first: JSON objects of up to ``PER_FILE`` tags each, so no task holds all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.han import convert, read_stages
from ..operators import aliases as A
from ..operators import cells as C
from ..operators import names as N
from ..operators import review as R
from ..operators import series as S
from ..operators import serving as V
from ..sources import readers, sinks
from ..sources import serving_store as store
from ..sources.shared import discard, new_path, written
from ..streaming import ingest as I
from . import index_queries as X
from . import name_queries as Q
from .fixture import duck, spark_view
from .name_queries import CONV, spelled

PER_FILE = 1000


def number(tag: str = "tag"):
    """The key that a tag is spelled from."""
    return F.regexp_extract(F.col(tag), r"\d+", 0).cast("long")


def json_files(spark: SparkSession, entries: DataFrame, name: str = "files") -> str:
    """A folder of JSON objects made of (tag, json): json is the value's JSON text."""
    path = new_path(spark, name)
    pair = F.concat(F.lit('"'), F.col("tag"), F.lit('":'), F.col("json"))
    body = F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(pair)), ","), F.lit("}"))
    entries.groupBy(F.floor(number() / PER_FILE).alias("batch")).agg(body.alias("value")).write.partitionBy("batch").text(path)
    return f"{path}/*/*.txt"


def quoted(col):
    return F.concat(F.lit('"'), col, F.lit('"'))


# --- the index by way of files


def built_index(spark, d) -> dict[str, DataFrame]:
    """Posts, tags and aliases written, read, aggregated; the six tables of the index written and read back."""
    x = X.Index(spark, d)
    paths = {n: new_path(spark, n) for n in ("posts", "tags", "aliases", "index")}
    for n in ("posts", "tags", "aliases"):
        x.view(n).write.parquet(paths[n])
    dim = C.tag_dim(readers.read_tags(spark, paths["tags"]), X.FLOOR)
    lookup = A.tag_lookup(dim, A.resolve_aliases(readers.read_aliases(spark, paths["aliases"])))
    posts = readers.read_posts(spark, paths["posts"])
    daily, totals = C.daily_cells(posts, lookup, X.FIRST), C.daily_totals(posts, X.FIRST)
    write = lambda df, n, keys: sinks.write_clustered(df, f"{paths['index']}/{n}", keys)
    write(dim, "dim_tag", ["tag_id"])
    write(daily, "fact_tag_daily", ["tag_id", "day"])
    write(totals, "fact_total_daily", ["day"])
    made = readers.read_index(spark, paths["index"], ("dim_tag", "fact_tag_daily", "fact_total_daily"))
    write(S.monthly(made["fact_tag_daily"], "tag_id"), "fact_tag_monthly", ["tag_id", "month"])
    write(S.monthly(made["fact_total_daily"]), "fact_total_monthly", ["month"])
    write(S.category_monthly(readers.read_index(spark, paths["index"], ("fact_tag_monthly",))["fact_tag_monthly"], made["dim_tag"]), "fact_category_monthly", ["category", "month"])
    return readers.read_index(spark, paths["index"])


def index_tables(spark, d):
    """Rows and posts of each table of an index that was built, written and read back."""
    tables, out = built_index(spark, d), None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("rows"), F.sum("post_count" if name == "dim_tag" else "posts").alias("posts")).select(F.lit(name).alias("name"), "rows", "posts")
        out = part if out is None else out.unionByName(part)
    return out


def index_category_months(spark, d):
    return X.rounded(built_index(spark, d)["fact_category_monthly"], "n_eff")


def _cells_and_totals(x, out):
    cells, totals = I.merged(x.spark, out, x.lookup)
    return cells.unionByName(totals.select(F.lit(-1).alias("tag_id"), "day", "posts", "fav_sum", "score_sum"))


def ingest_replayed(spark, d):
    """The last slice's totals and commits are lost, as after a crash between its writes; a second run replays that slice. Equals daily_cells."""
    x = X.Index(spark, d)
    source, out, ckpt = (new_path(spark, n) for n in ("posts", "ingest", "ingest-checkpoint"))
    posts = x.view("posts")
    posts.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 2).parquet(source)
    settings = {"floor": X.FLOOR, "deleted": False}
    I.ingest(stream, out, ckpt, settings, X.FIRST)
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(ckpt).getFileSystem(hadoop)
    last = max(lo for lo, _ in I.committed(spark, out))
    for lost in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc", f"{out}/totals/batch={last}", f"{out}/done/batch={last}"):
        fs.delete(jvm.org.apache.hadoop.fs.Path(lost), True)
    I.ingest(spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 2).parquet(source), out, ckpt, settings, X.FIRST)
    return _cells_and_totals(x, out)


ID_SLICES = 11


def ingest_ids(spark, d):
    """Posts ingested by ranges of ids, in a run to half the ids and one to the end, slices merged by threes; equals daily_cells."""
    x = X.Index(spark, d).kept()
    source, out, ckpt = (new_path(spark, n) for n in ("posts", "ingest", "ingest-checkpoint"))
    sinks.write_clustered(x.view("posts"), source, ["id"])
    posts = readers.read_posts(spark, source)
    bound = C.next_id(posts).first().max_id  # one row
    chunk = -(-bound // ID_SLICES)
    for end in (6 * chunk, None):
        I.ingest_ranges(posts, out, ckpt, chunk, {"floor": X.FLOOR}, X.FIRST, max_id=end, fan=3)
    runs = I.committed(spark, out)
    if sum(hi == lo + 1 for lo, hi in runs) != ID_SLICES or (0, 9) not in runs:
        raise AssertionError(f"slices do not follow the chunk size: {sorted(runs)}")
    I.expire(spark, out)
    return _cells_and_totals(x, out)


TOP = ["part_4", "part_8", "part_22", "part_25", "part_33"]


def chart_share(spark, d):
    x = X.Index(spark, d)
    return X.rounded(S.chart(x.months, x.dim, x.totals, TOP, "share", window=12), "smoothed", "value")


def chart_relative(spark, d):
    x = X.Index(spark, d)
    return X.rounded(S.chart(x.months, x.dim, x.totals, TOP, "relative", 5, 70, window=12), "smoothed", "value")


# --- readers of JSON and TSV


def name_map_files(spark, d):
    rows = spelled(spark, d).select("tag", F.to_json(F.create_map(F.lit("ja"), F.col("kana"), F.lit("zh_hans"), F.col("hans"))).alias("json"))
    return readers.read_name_map(spark, json_files(spark, rows))


def layer_files(spark, d):
    """Plain and object values of a layer."""
    v = F.when(F.col("k") % 3 == 0, F.concat(F.lit('{"zh_hant":'), quoted(F.col("hant")), F.lit("}"))).otherwise(quoted(F.col("hans")))
    return readers.read_layer(spark, json_files(spark, spelled(spark, d).select("tag", v.alias("json"))))


def rejection_files(spark, d):
    """Tags rejected by name, with their slots."""
    tags = spelled(spark, d).where("k % 7 = 0").select("tag", quoted(F.col("hans")).alias("json"))
    rejected = readers.read_rejections(spark, json_files(spark, tags))
    return N.slots(N.reject_layer(Q.folded(spark, d), rejected)).where("status = 'rejected'").select("tag", "lang")


def pool_files(spark, d):
    """Alias pools of the dimension's tags."""
    v = F.concat(F.lit('['), quoted(F.col("kana")), F.lit(',"",'), quoted(F.col("latin")), F.lit("]"))
    path = json_files(spark, spelled(spark, d).select("tag", F.when(F.col("k") % 5 == 0, F.lit('[""]')).otherwise(v).alias("json")))
    dim = C.tag_dim(spark_view(spark, d, "tags"), X.FLOOR)
    return readers.read_alias_pool(spark, path, dim.select(F.col("name").alias("tag"))).select("tag", F.array_join("names", "|").alias("names"))


def translation_files(spark, d):
    """A translation table, judged."""
    value = F.when(F.col("k") % 3 == 0, F.col("hans")).when(F.col("k") % 3 == 1, F.col("tag")).otherwise(F.col("latin"))
    return R.accept_translations(readers.read_translation_table(spark, json_files(spark, spelled(spark, d).select("tag", quoted(value).alias("json")))))


def override_files(spark, d):
    """Language overrides; values that are not lists are ignored."""
    v = F.when(F.col("k") % 4 == 0, F.lit('["ja","zh_hant"]')).otherwise(F.lit('"no"'))
    return readers.read_overrides(spark, json_files(spark, spelled(spark, d).select("tag", v.alias("json")))).select("name", F.array_join("langs", ",").alias("langs"))


def variant_files(spark, d):
    v = F.when(F.col("k") % 2 == 0, F.concat(F.lit('{"zh_hans":'), quoted(F.col("hans")), F.lit("}"))).otherwise(quoted(F.col("kana")))
    return readers.read_variants(spark, json_files(spark, spelled(spark, d).select("tag", v.alias("json"))))


def batch_answers(spark, d):
    """Answer files in folders named by their batch: plain and object answers, nulls dropped, every ninth file corrupt."""
    v = F.when(F.col("k") % 3 == 0, F.lit("null")).when(F.col("k") % 3 == 1, F.concat(F.lit('{"zh_hans":'), quoted(F.col("hans")), F.lit("}"))).otherwise(quoted(F.col("hans")))
    rows = spelled(spark, d).select(F.floor(F.col("k") / 50).cast("int").alias("batch"), F.concat(quoted(F.col("tag")), F.lit(":"), v).alias("pair"))
    body = F.concat(F.lit("﻿{"), F.array_join(F.array_sort(F.collect_list("pair")), ","), F.when(F.col("batch") % 9 == 4, "").otherwise("}"))
    root = new_path(spark, "batches")
    # tasks name their files, so their folders bear the batch; renaming each file would be the driver's work alone
    sinks.write_lines(rows.groupBy("batch").agg(body.alias("value")), root)
    answers, states = readers.read_batches(spark, root, files="*/*.txt", number=r"batch=(\d+)/[^/]*$")
    return answers.unionByName(states.where("corrupt").select("batch", F.lit(None).cast("string").alias("tag"), F.lit("corrupt").alias("value")))


def shard_files(spark, d):
    """Review shards of two layouts."""
    one, two = new_path(spark, "shards"), new_path(spark, "shards")
    rows = spelled(spark, d)
    tsv = lambda df, path: df.coalesce(2).write.option("sep", "\t").option("header", True).csv(path)
    tsv(rows.where("k % 2 = 0").select("tag", F.col("hans").alias("current_zh")), one)
    tsv(rows.where("k % 2 = 1").select(F.col("tag").alias("qualifier"), F.col("hans").alias("before"), F.col("hant").alias("after")), two)
    first, second = (readers.read_review_shards(spark, f"{p}/*.csv") for p in (one, two))
    return first.select("tag", "current_zh").unionByName(second.select("tag", F.col("after").alias("current_zh")))


def proposal_files(spark, d):
    """Proposals of two rounds in two folders; a file holds as many objects as it happens to get."""
    folders = []
    for k, letter in enumerate("ab"):
        root = new_path(spark, f"round{letter}")
        rows = spelled(spark, d).where(f"k % 2 = {k}").select(F.floor(F.col("k") / PER_FILE).alias("part"), F.concat(quoted(F.col("tag")), F.lit(":"), quoted(F.col("hans"))).alias("pair"))
        body = F.concat(F.lit('{"fixes":{'), F.array_join(F.array_sort(F.collect_list("pair")), ","), F.lit('},"reject":["x"]}'))
        rows.groupBy("part").agg(body.alias("value")).select("value").write.text(root)
        folders.append(root)
    return readers.read_proposals(spark, folders, ["none*.json", "part-*.txt"]).select("tag", "round", "value")


# --- writers


def exported_pool(spark, d):
    path = new_path(spark, "pool")
    sinks.export_alias_pool(readers.alias_pool(Q.wiki(spark, d)), C.tag_dim(spark_view(spark, d, "tags"), X.FLOOR), path)
    return spark.read.schema("tag string, names array<string>").json(path).select("tag", F.array_join("names", "|").alias("names"))


def exported_buckets(spark, d):
    path = new_path(spark, "buckets")
    tags = spark_view(spark, d, "tags").select(F.col("name").alias("tag"), "category")
    sinks.export_buckets(Q._buckets(spark, d).join(tags, "tag"), path)
    back = spark.read.schema("tag string, names map<string,array<string>>, category int").json(path)
    return back.select("category", "tag", F.explode("names").alias("lang", "n")).select("category", "tag", "lang", F.array_join("n", "|").alias("names"))


def batch_files(spark, d):
    """Review batches written, a folder each, and read back; an earlier, larger run leaves nothing."""
    path = new_path(spark, "batches")
    dim = Q.dim(spark, d).select("name", "post_count", "category")
    order = [F.desc("post_count"), F.col("name")]
    sinks.write_batches(R.numbered(dim, order, 10), path)
    sinks.write_batches(R.numbered(dim.where("category in (3, 4)"), order, 50), path)
    return spark.read.schema("name string, post_count long, category int, batch int").json(path).select("name", "batch")


def written_layer(spark, d):
    """A merged layer, written because it is applied; without that nothing is written."""
    path, unwritten = new_path(spark, "layer"), new_path(spark, "layer")
    rows = spelled(spark, d)
    existing = Q._existing(spark, d)
    accepted = rows.where("k % 2 = 0").select("tag", F.concat("hans", F.lit("山")).alias("value"))
    sinks.write_layer(existing, accepted, path, apply=True)
    sinks.write_layer(existing, accepted, unwritten)
    if readers.exists(spark, unwritten):
        raise AssertionError("a report wrote its layer")
    return spark.read.schema("tag string, value string").parquet(path)


# --- whole chains


def resolved_names(spark, d):
    """All layers and passes by resolve_names, for tags of even keys. Names with a variant of their own meet their base tag's."""
    rows = spelled(spark, d)
    variant = rows.where("k % 40 = 4").select(F.concat("tag", F.lit("_(set)")).alias("tag"), F.lit("zh_hans").alias("lang"), F.col("hans").alias("name"))
    layer = lambda name: readers.parse_layer(Q._layer(spark, d, name))
    copyrights = rows.where("k % 11 = 0").select("tag")
    set_label = spark.range(1).select(F.lit("set").alias("qualifier"), F.lit("国剑").alias("label"))
    wanted = rows.where("k % 2 = 0").select("tag").unionByName(variant.select("tag"))
    maps = [Q._layer(spark, d, "base").unionByName(variant), Q._layer(spark, d, "second")]
    out = N.resolve_names(maps, layer("general"), layer("supplement"), Q._layer(spark, d, "rejected"), [layer("manual")], copyrights, set_label, set_label.limit(0), CONV, wanted)
    return out.select("tag", *N.LANGS, "rejected")


def _served(spark, d) -> tuple[DataFrame, ...]:
    """(dim, tag months, totals, names, pool) of the serving tables. Several tables are made of each, so what takes joins is written once."""
    x = X.Index(spark, d).kept()
    dim = C.tag_dim(x.view("tags"), 0, excluded=None)
    months = C.monthly_cells(x.view("posts"), A.tag_lookup(dim, x.resolved), X.FIRST)
    return dim, written(months), written(x.totals), written(Q.folded(spark, d)), Q._pool(spark, d)


def serving_tables(spark, d):
    """Every table behind chart and search, in one long form."""
    made = V.serving_rows(*_served(spark, d), CONV, min_posts=X.FLOOR)
    text = lambda c: F.col(c).cast("string")
    parts = [
        made["totals"].select(F.lit("totals").alias("kind"), text("month").alias("key"), text("posts").alias("value")),
        made["tags"].select(F.lit("tags").alias("kind"), F.col("name").alias("key"), F.concat_ws(";", text("first_i"), F.array_join(F.col("values").cast("array<string>"), ",")).alias("value")),
        made["names"].select(F.lit("names").alias("kind"), F.col("tag").alias("key"), F.concat_ws(";", text("pos"), F.coalesce("lang", F.lit("-")), "name").alias("value")),
        made["search"].select(F.lit("search").alias("kind"), F.col("tag").alias("key"), F.array_join("terms", "|").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def serving_set(spark, d):
    """All six tables of a published set in one long form. An older version, of fewer tags, was current before."""
    root = new_path(spark, "serving")
    dim, months, totals, names, pool = _served(spark, d)
    categories = written(S.category_monthly(months, dim))
    for floor in (4 * X.FLOOR, X.FLOOR):
        made = V.serving_set(dim, months, totals, categories, names, pool, CONV, min_posts=floor)
        store.publish(made, root)
        discard(*made.values())
    tables = store.read_serving(spark, root)
    store.expire_versions(spark, root)
    text = lambda c: F.col(c).cast("string")
    tags, meta = tables["tags"], tables["meta"]
    facts = ("epoch", "months", "first_complete", "last_complete", "categories", "tags", "displayable", "translated")
    parts = [
        tables["totals"].select(F.lit("totals").alias("kind"), text("month").alias("key"), text("posts").alias("value")),
        tables["categories"].select(F.lit("categories").alias("kind"), F.concat_ws(";", text("category"), text("i")).alias("key"), F.concat_ws(";", text("posts"), F.round(F.col("n_eff") * 1e6).cast("long").cast("string")).alias("value")),
        tags.select(F.lit("tags").alias("kind"), F.col("name").alias("key"), F.concat_ws(";", text("first_i"), F.array_join(F.col("values").cast("array<string>"), ",")).alias("value")),
        tables["names"].select(F.lit("names").alias("kind"), F.col("tag").alias("key"), F.concat_ws(";", text("pos"), F.coalesce("lang", F.lit("-")), "name").alias("value")),
        tables["search"].select(F.lit("search").alias("kind"), F.col("tag").alias("key"), F.array_join("terms", "|").alias("value")),
        meta.select(F.lit("meta").alias("kind"), F.explode(F.create_map(*[v for k in facts for v in (F.lit(k), text(k))])).alias("key", "value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def search_stored(spark, d):
    """The queries of search_many over stored postings."""
    path = new_path(spark, "grams")
    store.write_postings(V.postings(written(Q._search_rows(spark, d))), path)  # a range sort samples what it sorts, and so makes it twice
    return V.search_stored(Q.asked(spark, d), path)


def copyright_map(spark, d):
    """The copyright picker, English by fallback where no official entry has one."""
    official = spelled(spark, d).where("k % 10 = 4").select("tag", F.lit(None).cast("string").alias("zh_hans"), F.lit("").alias("zh_hant"), F.lit("").alias("ja"), F.when(F.col("k") % 20 == 4, F.col("latin")).alias("en"), F.col("hangul").alias("ko"))
    out = N.build_map(Q._buckets(spark, d), N.pick_copyright, CONV, official, en_fallback=T.title_slug)
    return out.select("tag", "zh_hans", "zh_hant", "ja", "en", "ko")


def search_current(spark, d):
    """Search that hides deprecated tags."""
    return V.search(Q._search_rows(spark, d), "あ", 25, hide_deprecated=Q.dim(spark, d))


def target_report(spark, d):
    names = Q.folded(spark, d).withColumn("en", F.when(number() % 2 == 0, F.col("en"))).withColumn("ja", F.when(number() % 3 == 0, F.col("ja")))
    done = R.reviewed([readers.parse_layer(Q._layer(spark, d, "supplement"))])
    return R.target_report(R.review_targets(Q.dim(spark, d), names, done, Q._pool(spark, d), "fill", floor=10))


def judge_targets(spark, d):
    """Two targets with categories and rules of their own, judged by one table."""
    rows = spelled(spark, d).repartition("k")  # few tasks would read the small table of parts
    targets = spark.createDataFrame([("any", None, False), ("gaps", [0, 3], True)], "target string, categories array<int>, gap_only boolean")
    both = rows.withColumn("target", F.explode(F.array(F.lit("any"), F.lit("gaps"), F.lit("unknown"))))
    proposals = both.select("target", "tag", F.lit(1).alias("round"), F.lit("a.json").alias("file"), F.concat("hans", F.lit("山")).alias("value"))
    late = both.where("k % 3 = 0 and target = 'any'").select("target", "tag", F.lit(2).alias("round"), F.lit("b.json").alias("file"), F.concat("hans", F.lit("水")).alias("value"))
    current = rows.where("k % 2 = 0").select("tag", F.col("hans").alias("value"))
    return R.judge_targets(proposals.unionByName(late), targets, rows.where("k % 5 <> 0").select("tag"), spark_view(spark, d, "tags"), current, CONV)


def long_signs(spark, d):
    """Runs of signs of any length."""
    n = (F.col("k") % 60 + 1).cast("int")
    raw = F.concat("hans", F.repeat(F.lit("!?"), n), F.when(F.col("k") % 2 == 0, F.col("hans")).otherwise(F.lit("a")))
    return spelled(spark, d).select("k", T.full_width(raw, "zh_hans").alias("fixed"))


#: A dictionary with phrases that overlap each other, and phrases of phrases.
WORDS = [("会国", "A"), ("国学", "B"), ("会国学", "C"), ("学图剑", "D"), ("剑乐", "E"), ("山水火木", "F"), ("山水", "G"), ("水火", "H"), ("木会", "I"), ("会", "j"), ("国", "k"), ("学", "l"), ("图", "m"), ("剑", "n"), ("乐", "o")]


def phrase_conversion(spark, d):
    """Longest match from left to right by a dictionary read from a table, with protected characters."""
    table = spark.createDataFrame([("w", a, b) for a, b in WORDS], "stage string, src string, dst string")
    stages = [read_stages(table)["w"]]
    twice = F.concat("hans", "hans", F.lit("山水火木会国学"))
    return spelled(spark, d).select("tag", convert(twice, stages).alias("plain"), convert(twice, stages, "学").alias("guarded"))


QUERIES = {f.__name__: f for f in (
    index_tables, index_category_months, ingest_replayed, ingest_ids, chart_share, chart_relative, name_map_files, layer_files, rejection_files, pool_files, translation_files, override_files, variant_files, batch_answers, shard_files, proposal_files,
    exported_pool, exported_buckets, batch_files, written_layer, resolved_names, serving_tables, serving_set, search_stored, copyright_map, search_current, target_report, judge_targets, long_signs, phrase_conversion,
)}


def _walk(text: str, protected: str = "") -> str:
    """SQL that steps through ``text`` by longest match."""
    tries = sorted(WORDS, key=lambda w: -len(w[0]))
    if protected:
        tries = [w for w in tries if not set(w[0]) & set(protected)]
    case = " ".join(f"WHEN starts_with(rest, '{a}') THEN '{b}'" for a, b in tries)
    size = " ".join(f"WHEN starts_with(rest, '{a}') THEN {len(a)}" for a, _ in tries)
    return f"""(SELECT tag, '' AS done, {text} AS rest FROM spelled UNION ALL SELECT tag, done || CASE {case} ELSE rest[1] END, substr(rest, 1 + CASE {size} ELSE 1 END) FROM W WHERE rest <> '')"""


TWICE = "hans || hans || '山水火木会国学'"
FIT = """fit AS (SELECT u.name, u.i::INT AS i, coalesce(p.v, 0) AS posts FROM (SELECT name, unnest(range(a, z + 1)) AS i FROM (SELECT name, min(i) AS a, max(i) AS z FROM vals GROUP BY name)) u LEFT JOIN vals p ON p.name = u.name AND p.i = u.i, whole WHERE u.i BETWEEN "first" AND "last")"""
SHOWN = """SELECT s.name, s.i, axis.month, round(f.posts::DOUBLE, 6) AS value, round(smoothed, 6) AS smoothed FROM smoothed s JOIN fit f ON f.name = s.name AND f.i = s.i JOIN axis ON axis.i = s.i
  WHERE s.i >= (SELECT min(i) FROM fit g WHERE g.name = s.name AND posts > 0)"""
NAMED = "(" + ", ".join(f"'{t}'" for t in TOP) + ")"
ANY_DIM = "dim AS (SELECT id AS tag_id, name, category::TINYINT AS category, post_count::BIGINT AS post_count, is_deprecated <> 0 AS is_deprecated FROM tags)"
POOLS = f"SELECT tag, kana || '|' || latin AS names FROM spelled JOIN tags ON name = tag WHERE k % 5 <> 0 AND post_count >= {X.FLOOR} AND category <> 1"
#: As the operator: from sums of whole numbers, which no order of adding up changes. The set's text holds millionths of n_eff, which sums of
#: rounded shares would tip over.
WHOLE_CATEGORIES = X.CATEGORIES.replace("1 / sum(s * s) AS n_eff", "sum(posts)::DOUBLE * sum(posts)::DOUBLE / sum((posts * posts)::DOUBLE) AS n_eff")
SERVED = ", ".join((ANY_DIM, X.RESOLVED, X.LOOKUP, X.LIVE, X.DAILY, X.TOTALS, X.MONTHS, X.TOTAL_MONTHS, X.AXIS, Q.FOLD, Q.LISTED, Q.TERMS)) + f", kept AS (SELECT name FROM dim WHERE post_count >= {X.FLOOR})"
SERVED_ROWS = """ SELECT 'totals' AS kind, month::VARCHAR AS key, coalesce(posts, 0)::VARCHAR AS value FROM axis LEFT JOIN totals USING (month)
        UNION ALL SELECT 'tags', name, min(i)::VARCHAR || ';' || string_agg(posts::VARCHAR, ',' ORDER BY i) FROM points WHERE name IN (FROM kept) GROUP BY name UNION ALL SELECT 'names', tag, pos::VARCHAR || ';' || coalesce(lang, '-') || ';' || name FROM listed WHERE tag IN (FROM kept)
        UNION ALL SELECT 'search', tag, array_to_string(terms, '|') FROM search_rows WHERE tag IN (FROM kept)"""
both = Q._sql
ORACLE_SQL = {
    "index_tables": X.sql(
        """SELECT 'dim_tag' AS name, count(*) AS rows, sum(post_count)::BIGINT AS posts FROM dim UNION ALL SELECT 'fact_tag_daily', count(*), sum(posts)::BIGINT FROM daily UNION ALL SELECT 'fact_total_daily', count(*), sum(posts)::BIGINT FROM total_daily
        UNION ALL SELECT 'fact_tag_monthly', count(*), sum(posts)::BIGINT FROM months UNION ALL SELECT 'fact_total_monthly', count(*), sum(posts)::BIGINT FROM totals UNION ALL SELECT 'fact_category_monthly', count(*), sum(posts)::BIGINT FROM categories""", *X.ALL, X.CATEGORIES),
    "index_category_months": X.ORACLE_SQL["category_monthly"],
    "ingest_replayed": X.sql("SELECT * FROM daily UNION ALL SELECT -1, * FROM total_daily", *X.CELLS, X.TOTALS),
    "ingest_ids": X.sql("SELECT * FROM daily UNION ALL SELECT -1, * FROM total_daily", *X.CELLS, X.TOTALS),
    "chart_share": X.sql(SHOWN, *X.ALL, X.AXIS, X.COMPLETE, f"vals AS (SELECT name, datediff('month', e, m.month)::INT AS i, m.posts * 10000 / t.posts AS v FROM epoch, months m JOIN dim USING (tag_id) JOIN totals t USING (month) WHERE name IN {NAMED})", FIT, X.SMOOTH.replace("{src}", "fit")),
    "chart_relative": X.sql(SHOWN + " AND s.i BETWEEN 5 AND 70", *X.ALL, X.CATEGORIES, X.AXIS, X.COMPLETE, f"vals AS (SELECT name, datediff('month', e, month)::INT AS i, s / (1 / n_eff - s * s) AS v FROM epoch, shares JOIN categories c USING (category, month) WHERE active_tags > 1 AND name IN {NAMED})", FIT, X.SMOOTH.replace("{src}", "fit")),
    "name_map_files": both("SELECT tag, 'ja' AS lang, kana AS name FROM spelled UNION ALL SELECT tag, 'zh_hans', hans FROM spelled"),
    "layer_files": both("SELECT tag, CASE WHEN k % 3 <> 0 THEN hans END AS value, NULL::VARCHAR AS hans, CASE WHEN k % 3 = 0 THEN hant END AS hant FROM spelled"),
    "rejection_files": both("SELECT tag, unnest(['zh_hans', 'zh_hant']) AS lang FROM spelled WHERE k % 7 = 0"),
    "pool_files": both(POOLS, views=Q.BOTH),
    "translation_files": both("SELECT tag, CASE k % 3 WHEN 0 THEN hans WHEN 1 THEN tag ELSE latin END AS name, CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'same-as-slug' ELSE 'no-han' END AS reason FROM spelled"),
    "override_files": both("SELECT tag AS name, 'ja,zh_hant' AS langs FROM spelled WHERE k % 4 = 0"),
    "variant_files": both("SELECT tag AS qualifier, CASE WHEN k % 2 = 0 THEN hans ELSE kana END AS label FROM spelled"),
    "batch_answers": both("SELECT (k // 50)::INT AS batch, tag, hans AS value FROM spelled WHERE k % 3 <> 0 AND (k // 50) % 9 <> 4 UNION ALL SELECT DISTINCT (k // 50)::INT, NULL, 'corrupt' FROM spelled WHERE (k // 50) % 9 = 4"),
    "shard_files": both("SELECT tag, CASE WHEN k % 2 = 0 THEN hans ELSE hant END AS current_zh FROM spelled"),
    "proposal_files": both("SELECT tag, 1 AS round, hans AS value FROM spelled"),
    "exported_pool": both(f"SELECT tag, kana || '|' || hant || '|' || hans || '|' || hangul || '| ' || latin || '|' || kana AS names FROM spelled JOIN tags ON name = tag WHERE k % 13 <> 0 AND k % 11 <> 0 AND post_count >= {X.FLOOR} AND category <> 1", views=Q.BOTH),
    "exported_buckets": both("SELECT category::INT AS category, tag, lang, string_agg(b.name, '|' ORDER BY pos) AS names FROM buckets b JOIN tags ON tags.name = tag GROUP BY ALL", Q.BUCKETS, views=Q.BOTH),
    "batch_files": both("SELECT name, ((row_number() OVER (ORDER BY post_count DESC, name) - 1) // 50)::INT AS batch FROM tags WHERE category IN (3, 4)", views=("tags",)),
    "written_layer": both("SELECT tag, CASE WHEN k % 2 = 0 THEN hans || '山' ELSE hans || '水' END AS value FROM spelled WHERE k % 2 = 0 OR k % 3 = 0"),
    "resolved_names": both(
        f"""SELECT tag, zh_hans, CASE WHEN zh_hans IS NOT NULL AND zh_hant IS NOT NULL AND ({Q.s2t('zh_hans')} = zh_hant OR NOT ({Q.traditional('zh_hant')})) THEN {Q.s2t('zh_hans')} ELSE zh_hant END AS zh_hant, ja, en, ko, rejected FROM folded WHERE regexp_extract(tag, '[0-9]+')::BIGINT % 2 = 0
        UNION ALL SELECT tag || '_(set)', hans || CASE WHEN k % 7 <> 0 AND k % 3 <> 0 AND k % 11 <> 0 THEN '（国剑）' ELSE '' END, NULL, NULL, NULL, NULL, false FROM spelled WHERE k % 40 = 4""", Q.FOLD),
    "serving_tables": duck(SERVED + SERVED_ROWS, "tags", "aliases", "posts", "spelled"),
    "serving_set": duck(
        SERVED.replace("kept AS", f"{WHOLE_CATEGORIES}, {X.COMPLETE}, kept AS") + SERVED_ROWS + """
        UNION ALL SELECT 'categories', t.category::VARCHAR || ';' || a.i::VARCHAR, coalesce(c.posts, 0)::VARCHAR || ';' || round(coalesce(c.n_eff, 0) * 1000000)::BIGINT::VARCHAR FROM (SELECT DISTINCT category FROM categories) t CROSS JOIN axis a LEFT JOIN categories c ON c.category = t.category AND c.month = a.month
        UNION ALL SELECT 'meta', unnest(['epoch', 'months', 'first_complete', 'last_complete', 'categories', 'tags', 'displayable', 'translated']), unnest([e::VARCHAR, (SELECT count(*) FROM axis)::VARCHAR, "first"::VARCHAR, "last"::VARCHAR, (SELECT count(DISTINCT category) FROM categories)::VARCHAR,
          (SELECT count(*) FROM kept)::VARCHAR, (SELECT count(*) FROM kept JOIN folded ON tag = name WHERE shown)::VARCHAR, (SELECT count(*) FROM kept JOIN folded ON tag = name JOIN spelled USING (tag) WHERE shown OR k % 2 = 0)::VARCHAR]) FROM epoch, whole""".replace("WHERE shown", "WHERE coalesce(zh_hans, zh_hant, ja, en, ko) <> ''"), "tags", "aliases", "posts", "spelled"),
    "search_stored": Q.ORACLE_SQL["search_many"],
    "copyright_map": both(
        """SELECT tag, CASE WHEN k % 10 <> 4 THEN hans END AS zh_hans, CASE WHEN k % 10 <> 4 THEN hant END AS zh_hant, CASE WHEN k % 10 <> 4 THEN kana END AS ja, CASE WHEN k % 20 = 4 THEN latin ELSE 'Part ' || k::VARCHAR END AS en, hangul AS ko
        FROM spelled JOIN tags ON name = tag WHERE k % 13 <> 0 AND k % 11 <> 0 AND post_count > 0 AND category IN (3, 4)""", views=Q.BOTH),
    "search_current": both("SELECT tag, list_filter(terms, lambda t: contains(t, 'あ'))[1] AS hit FROM search_rows JOIN tags ON name = tag WHERE is_deprecated = 0 AND len(list_filter(terms, lambda t: contains(t, 'あ'))) > 0 ORDER BY tag LIMIT 25", Q.FOLD, Q.LISTED, Q.TERMS, views=Q.BOTH),
    "target_report": both(
        """SELECT CASE category WHEN 3 THEN 'copyright' ELSE 'character' END AS category, count(*) AS targets, count(*) FILTER (k % 2 = 0 OR k % 3 = 0) AS anchored, (count(*) FILTER (k % 2 = 0 OR k % 3 = 0) * 100 // count(*))::BIGINT AS rate
        FROM folded f JOIN spelled s ON s.tag = f.tag JOIN tags ON tags.name = f.tag WHERE category IN (3, 4) AND post_count >= 10 AND zh_hans IS NULL GROUP BY category""", Q.FOLD, views=Q.BOTH),
    "judge_targets": both(
        """SELECT target, tag, round, file, value, CASE WHEN k % 5 = 0 THEN 'not in a shard' WHEN target = 'gaps' AND category NOT IN (0, 3) THEN 'wrong category' WHEN target = 'gaps' AND k % 2 = 0 THEN 'already named' WHEN round = 1 AND target = 'any' AND k % 3 = 0 THEN 'superseded' END AS reason FROM (
        SELECT t AS target, tag, k, 1 AS round, 'a.json' AS file, hans || '山' AS value FROM spelled, unnest(['any', 'gaps']) u(t) UNION ALL SELECT 'any', tag, k, 2, 'b.json', hans || '水' FROM spelled WHERE k % 3 = 0) JOIN tags ON name = tag""", views=Q.BOTH),
    "long_signs": both("SELECT k, hans || CASE WHEN k % 2 = 0 THEN repeat('！？', (k % 60 + 1)::INT) || hans ELSE repeat('!?', (k % 60 + 1)::INT) || 'a' END AS fixed FROM spelled"),
    "phrase_conversion": both("SELECT p.tag, p.done AS plain, g.done AS guarded FROM plain p JOIN guarded g USING (tag) WHERE p.rest = '' AND g.rest = ''", f"plain AS {_walk(TWICE).replace('FROM W', 'FROM plain')}", f"guarded AS {_walk(TWICE, '学').replace('FROM W', 'FROM guarded')}"),
}
