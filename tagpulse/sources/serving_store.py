"""The serving set on disk: six tables that are published together, and the tables behind look-ups and search.

A version is a folder of its own. It becomes the current one when the pointer file is replaced, in one rename, after all its
tables are written. A reader asks for the pointer once and takes every table from that version, so it never mixes two.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .readers import exists

#: The set's tables, and the columns by which each is clustered.
TABLES = {"totals": ["i"], "categories": ["category", "i"], "tags": ["name"], "names": ["tag", "pos"], "search": ["tag"], "meta": []}
#: Row groups of tables that are read by key: small, so that a look-up reads little.
KEYED_BLOCK = 8 << 20
#: So many sought keys are handed to the scan as a list; beyond that they only come by way of the join.
LISTED_KEYS = 1000
#: The same of beginnings of keys, each of which is a condition of its own.
LISTED_STARTS = 50


def write_keyed(df: DataFrame, path: str, keys: list[str], bloom: bool = True) -> None:
    """Range-sorted by ``keys``, in small row groups, with a Bloom filter on the first key.

    A look-up of one key reads the row groups whose range holds it, and of those only the ones whose filter does.
    """
    write = (df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df.coalesce(1)).write.option("compression", "zstd").option("parquet.block.size", KEYED_BLOCK)
    if bloom and keys:
        write = write.option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    write.mode("overwrite").parquet(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def publish(tables: dict[str, DataFrame], root: str) -> str:
    """Writes a version of the set and makes it the current one; returns its name."""
    if set(tables) != set(TABLES):
        raise ValueError(f"the serving set has {sorted(TABLES)}, not {sorted(tables)}")
    spark, version = tables["meta"].sparkSession, f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        write_keyed(df, f"{root}/{version}/{name}", TABLES[name])
    point_to(spark, root, version)
    return version


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Replaces the pointer by one rename."""
    jvm = spark.sparkContext._jvm
    fs, temp = _hadoop(spark, f"{root}/pointer-{version}")
    out = fs.create(temp, True)
    out.write(bytearray(version.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri() if temp.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(temp, jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT"), over)


def current_version(spark: SparkSession, root: str) -> str:
    fs, p = _hadoop(spark, f"{root}/CURRENT")
    if not fs.exists(p):
        raise FileNotFoundError(f"no serving set is published at {root}")
    stream = fs.open(p)
    try:
        version = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    if not re.fullmatch(r"v-[0-9a-f]{32}", version):
        raise ValueError(f"{root}/CURRENT names no version: {version[:80]!r}")
    return version


def read_serving(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame]:
    """The six tables of one version, by default the current one."""
    version = version or current_version(spark, root)
    return {name: spark.read.parquet(f"{root}/{version}/{name}") for name in TABLES}


def expire_versions(spark: SparkSession, root: str, keep: list[str] | None = None) -> None:
    """Deletes all versions but the current one and those of ``keep``, when no reader uses them any more."""
    stay = {current_version(spark, root), *(keep or [])}
    fs, p = _hadoop(spark, root)
    for s in fs.listStatus(p):
        if s.isDirectory() and s.getPath().getName().startswith("v-") and s.getPath().getName() not in stay:
            fs.delete(s.getPath(), True)


# --- search by stored grams


def write_postings(postings: DataFrame, path: str) -> None:
    """Postings (gram, tag, term) clustered by gram, and each gram's frequency. A frequent gram spans several row groups."""
    write_keyed(postings, f"{path}/postings", ["gram", "tag"])
    counts = postings.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("f"))
    write_keyed(counts, f"{path}/frequency", ["gram"])


def read_by_key(spark: SparkSession, path: str, key: str, sought: DataFrame) -> DataFrame:
    """Rows of a keyed table for the keys of ``sought``. Where these are few, the scan gets them as a list and skips row groups."""
    table = spark.read.parquet(path)
    few = [r[0] for r in sought.select(key).distinct().limit(LISTED_KEYS + 1).collect()]  # LISTED_KEYS + 1 at most
    if len(few) <= LISTED_KEYS:
        table = table.where(F.col(key).isin(few)) if few else table.limit(0)
    return table


def read_by_prefix(spark: SparkSession, path: str, key: str, starts: DataFrame) -> DataFrame:
    """Rows of a keyed table whose key begins with one of ``starts`` (one column), where these are few; else all rows, for a join."""
    table = spark.read.parquet(path)
    few = [r[0] for r in starts.distinct().limit(LISTED_STARTS + 1).collect()]  # LISTED_STARTS + 1 at most
    return table.where(reduce(or_, [F.col(key).startswith(s) for s in few])) if 0 < len(few) <= LISTED_STARTS else table


def require_tables(spark: SparkSession, schemas: dict[str, str]) -> None:
    """Refuses to go on unless each path holds a Parquet table with the columns and types of its schema."""
    for path, schema in schemas.items():
        if not exists(spark, path):
            raise FileNotFoundError(f"missing: {path}")
        there = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}
        wrong = [f"{f.name} {f.dataType.simpleString()}, found {there.get(f.name, 'none')}" for f in StructType.fromDDL(schema).fields if there.get(f.name) != f.dataType.simpleString()]
        if wrong:
            raise ValueError(f"{path} is not as declared: {'; '.join(wrong)}")
