"""Readers. JSON files are read as whole texts and parsed by declared schemas; paths may lie in any store Spark reads.

A file can hold several JSON values one after the other; all are read. A file that cannot be read to its end, or not by its schema,
is an error, raised by whatever uses its rows and naming the file; ``corrupt_files`` lists such files instead.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType
from pyspark.sql.utils import AnalysisException

from .. import schemas

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Names of files without a byte, which Spark's readers pass over."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for s in fs.globStatus(p) or []:
        found += fs.listStatus(s.getPath()) if s.isDirectory() else [s]
    return [s.getPath().toString() for s in found if s.isFile() and not s.getLen() and s.getPath().getName()[0] not in "_."]


#: Ids a partition of a database scan.
SCAN_IDS = 500_000


def id_bounds(spark: SparkSession, jdbc: dict) -> tuple[int, int] | None:
    """The least and the largest id of a database table, found there; None if it is empty."""
    quote = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(jdbc["url"]).quoteIdentifier
    ends = f"(SELECT min({quote('id')}) AS {quote('lo')}, max({quote('id')}) AS {quote('hi')} FROM {jdbc.get('table', 'posts')}) ends"
    r = spark.read.jdbc(jdbc["url"], ends, properties=jdbc.get("properties", {})).first()  # one row
    return None if r.lo is None else (r.lo, r.hi)


def read_posts(spark: SparkSession, path: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """Posts from Parquet, or from a database (url; table, properties, lower, upper, partitions).

    A database is scanned in ranges of ids, by default from its least to its largest, SCAN_IDS a partition. Filters and the
    choice of columns go to the database.
    """
    if not jdbc:
        return spark.read.schema(schemas.POSTS).parquet(path)
    ends = (jdbc["lower"], jdbc["upper"]) if "lower" in jdbc and "upper" in jdbc else id_bounds(spark, jdbc)
    if ends is None:
        return spark.createDataFrame([], schemas.POSTS)
    lower, upper = ends[0], max(ends[1], ends[0] + 1)
    parts = jdbc.get("partitions") or -(-(upper - lower + 1) // SCAN_IDS)
    return spark.read.jdbc(jdbc["url"], jdbc.get("table", "posts"), column="id", lowerBound=lower, upperBound=upper, numPartitions=parts, properties=jdbc.get("properties", {}))


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TAGS).parquet(path)


def active_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.where("status = 'active' AND antecedent_name <> '' AND consequent_name <> ''").select("antecedent_name", "consequent_name")


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    return active_aliases(spark.read.schema(schemas.ALIASES).parquet(path))


def read_wiki(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WIKI).parquet(path)


def alias_pool(wiki: DataFrame) -> DataFrame:
    """(tag, names) of live pages (null: live), order kept; bad JSON and empty pools are left out."""
    live = wiki.where(F.coalesce(F.col("is_deleted"), F.lit(0)) == 0)
    names = F.filter(F.from_json("other_names", "array<string>"), lambda x: x != "")
    return live.select(F.col("title").alias("tag"), names.alias("names")).where(F.size("names") > 0)


def read_index(spark: SparkSession, folder: str, names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """The index's tables, or those named."""
    kinds = {"dim_tag": schemas.DIM_TAG, "fact_tag_daily": schemas.DAILY, "fact_total_daily": schemas.TOTAL_DAILY, "fact_tag_monthly": schemas.MONTHLY, "fact_total_monthly": schemas.TOTAL_MONTHLY, "fact_category_monthly": schemas.CATEGORY_MONTHLY}
    return {k: spark.read.schema(s).parquet(f"{folder}/{k}") for k, s in kinds.items() if names is None or k in names}


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, body), a leading byte-order mark cut off."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", "^\\uFEFF", "").alias("body"))


def json_values(text: str) -> tuple[list[str], str | None]:
    """The texts of the JSON values that stand one after the other in ``text``, and what is wrong behind them."""
    out, at, decoder = [], 0, json.JSONDecoder()
    while at < len(text):
        if text[at] in " \t\r\n":
            at += 1
            continue
        try:
            _, end = decoder.raw_decode(text, at)
        except ValueError as e:
            return out, str(e)
        out.append(text[at:end])
        at = end
    return out, None if out else "no JSON value"


def split_values(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, body, error): a row for each JSON value of a file, at is its place; one with an error where a file breaks off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                bodies, error = json_values(text)
                rows = [(body, None) for body in bodies] + ([(None, error)] if error else [])
                columns = [pa.array([file] * len(rows)), pa.array(range(len(rows)), pa.int32()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "body", "error"])

    rows = whole_texts(spark, path).mapInArrow(run, "file string, at int, body string, error string")
    blank = [(f, 0, None, "no JSON value") for f in empty_files(spark, path)]
    return rows.unionByName(spark.createDataFrame(blank, rows.schema)) if blank else rows


def parsed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, at, j, error): as split_values, with j parsed by ``schema``; an error too where a value is not of that kind."""
    kind = DataType.fromDDL(schema)
    good = F.col("body").startswith("[" if isinstance(kind, ArrayType) else "{") & F.col("j").isNotNull()
    for field in kind.names if isinstance(kind, StructType) else []:  # one of another kind is read as null
        good = good & (F.get_json_object("body", f"$.{field}").isNull() | F.col("j")[field].isNotNull())
    error = F.when(F.col("error").isNull() & ~good, F.lit(f"not {schema}")).otherwise(F.col("error"))
    return split_values(spark, path).withColumn("j", F.from_json("body", schema)).select("file", "at", "j", error.alias("error"))


def corrupt_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, error) of the files that cannot be read whole by ``schema``."""
    return parsed(spark, path, schema).where("error IS NOT NULL").groupBy("file").agg(F.min_by("error", "at").alias("error"))


def sound(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` whose ``value`` raises where their file has an error. It stands in the value, since filters may be moved."""
    stop = F.raise_error(F.concat(F.lit("corrupt file "), "file", F.lit(": "), "error"))
    return rows.withColumn(value, F.when(F.col("error").isNull(), F.col(value)).otherwise(stop)).drop("error")


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, at, j) of all values; raises at a corrupt file."""
    return sound(parsed(spark, path, schema), "j")


def read_name_map(spark: SparkSession, path: str) -> DataFrame:
    """(tag, lang, name); a missing file gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "tag string, lang string, name string")
    each = _json(spark, path, "map<string,map<string,string>>").select(F.explode("j").alias("tag", "m"))
    return each.select("tag", F.explode("m").alias("lang", "name"))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """(tag, value, hans, hant): a string sets value, an object its scripts; a missing file gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "tag string, value string, hans string, hant string")
    return parse_layer(_json(spark, path, "map<string,string>").select(F.explode("j").alias("tag", "v")))


def parse_layer(rows: DataFrame) -> DataFrame:
    """(tag, v) with plain or JSON object values as a layer."""
    inner = F.from_json(F.when(F.col("v").startswith("{"), F.col("v")), "map<string,string>")
    return rows.select("tag", F.when(~F.col("v").startswith("{"), F.col("v")).alias("value"), F.try_element_at(inner, F.lit("zh_hans")).alias("hans"), F.try_element_at(inner, F.lit("zh_hant")).alias("hant"))


def read_rejections(spark: SparkSession, path: str) -> DataFrame:
    """Tags of a JSON list, or the keys of a JSON object."""
    tags = F.coalesce(F.from_json(F.when(F.col("body").startswith("["), F.col("body")), "array<string>"), F.map_keys(F.from_json(F.when(F.col("body").startswith("{"), F.col("body")), "map<string,string>")))
    rows = split_values(spark, path).withColumn("tags", tags)
    wrong = F.when(F.col("error").isNull() & F.col("tags").isNull(), "neither a list nor an object").otherwise(F.col("error"))
    return sound(rows.withColumn("error", wrong), "tags").select(F.explode("tags").alias("tag"))


def read_alias_pool(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(tag, names) of wanted tags; a missing pool is an error, since search would silently lose its aliases."""
    if not exists(spark, path):
        raise FileNotFoundError(f"alias pool not found: {path}")
    each = _json(spark, path, "map<string,array<string>>").select(F.explode("j").alias("tag", "names"))
    kept = each.select("tag", F.filter("names", lambda n: n != "").alias("names")).where(F.size("names") > 0)
    return kept.join(wanted.select("tag").distinct(), "tag", "left_semi")


def read_review_shards(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of tab-separated shards of any layout; tag is the column tag, else qualifier."""
    header = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False)
    out = None
    for path in sorted(r.file for r in spark.read.format("binaryFile").load(pattern).select(F.col("path").alias("file")).collect()):  # names of files only
        part = header.csv(path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise AnalysisException(f"no shards match {pattern}")
    keys = [F.nullif(F.col(c), F.lit("")) for c in ("tag", "qualifier") if c in out.columns]
    return out.withColumn("tag", F.coalesce(*keys)).where(F.col("tag").isNotNull())


def read_proposals(spark: SparkSession, folders: list[str], rounds: list[str]) -> DataFrame:
    """(tag, round, file, value) of every proposal; round is the place of the file's pattern in ``rounds``.

    Of a file's values all count; where two of them propose for one tag, the later one holds, as within one object.
    """
    out = None
    for k, pattern in enumerate(rounds):
        for folder in folders:
            if exists(spark, f"{folder}/{pattern}"):
                rows = _json(spark, f"{folder}/{pattern}", schemas.PROPOSALS)
                each = rows.select("file", "at", F.explode("j.fixes").alias("tag", "value"))
                part = each.groupBy("file", "tag").agg(F.max_by("value", "at").alias("value"))
                part = part.select("tag", F.lit(k).alias("round"), F.element_at(F.split("file", "/"), -1).alias("file"), "value")
                out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "tag string, round int, file string, value string")


def read_batches(spark: SparkSession, folder: str, kind: str = "out", files: str | None = None, number: str = r"_(\d+)\.json$") -> tuple[DataFrame, DataFrame]:
    """((batch, tag, value), (batch, corrupt)): answers, plain or {zh_hans}, nulls dropped; the state of each file.

    ``files`` and ``number``: which files of the folder are read, and the pattern of the batch in their paths, where they are not
    named kind_number.json; Spark writes batch=number/part-... .
    """
    batch = F.regexp_extract("file", number, 1).cast("int")
    rows = parsed(spark, f"{folder}/{files or f'{kind}_*.json'}", "map<string,string>").withColumn("batch", batch)
    states = rows.groupBy("batch").agg(F.bool_or(F.col("error").isNotNull()).alias("corrupt"))
    whole = rows.join(states.where("NOT corrupt").select("batch"), "batch", "left_semi")
    each = parse_layer(whole.select("batch", F.explode("j").alias("tag", "v")).select(F.struct("batch", "tag").alias("tag"), "v"))
    answers = each.select("tag.batch", "tag.tag", F.coalesce("value", "hans").alias("value")).where(F.col("value").isNotNull())
    return answers, states


def clean_picks(df: DataFrame) -> DataFrame:
    """(tag, picks): non-empty strings of ja, ko, zh_hans and zh_hant, trimmed."""
    langs = F.array(*[F.lit(c) for c in ("ja", "ko", "zh_hans", "zh_hant")])
    trimmed = F.transform_values("picks", lambda k, v: F.trim(v))
    return df.select("tag", F.map_filter(trimmed, lambda k, v: F.array_contains(langs, k) & v.isNotNull() & (v != "")).alias("picks"))


def read_translation_table(spark: SparkSession, path: str) -> DataFrame:
    """(tag, name) of a flat JSON object."""
    return _json(spark, path, "map<string,string>").select(F.explode("j").alias("tag", "name"))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(name, langs); values that are not lists are ignored, a missing file gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "name string, langs array<string>")
    rows = _json(spark, path, "map<string,string>").select(F.explode("j").alias("name", "v"))
    return rows.select("name", F.from_json("v", "array<string>").alias("langs")).where(F.col("langs").isNotNull())


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """(qualifier, label)."""
    return read_layer(spark, path).select(F.col("tag").alias("qualifier"), F.coalesce("value", "hans").alias("label"))
