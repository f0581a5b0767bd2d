"""Sinks: clustered Parquet, exports, batches, layers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..operators.names import slots
from ..operators.review import merge_layer


#: For writes of a great many files: tasks move their own files to their places when they end, which else the driver does one by one
#: at the end. Should the job fail half way, some files are left there; a repetition overwrites them.
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def write_clustered(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """Range-sorted by ``keys``: a key's rows lie together, so row groups are skipped by their statistics."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).option("compression", "zstd").parquet(path)


def export_alias_pool(pool: DataFrame, dim: DataFrame, path: str) -> None:
    pool.join(dim.select(F.col("name").alias("tag")).distinct(), "tag", "left_semi").write.mode("overwrite").json(path)


def export_buckets(buckets: DataFrame, path: str) -> None:
    """A row a tag, {lang: [names]}, in a folder for each category."""
    named = buckets.groupBy("category", "tag", "lang").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("n"))
    maps = named.groupBy("category", "tag").agg(F.map_from_entries(F.collect_list(F.struct("lang", F.col("n.name")))).alias("names"))
    maps.write.mode("overwrite").partitionBy("category").json(path)


def display_name_rows(names: DataFrame) -> DataFrame:
    """(tag, names): JSON of the slots in order, null where rejected; tags without a slot are left out."""
    grouped = slots(names).groupBy("tag").agg(F.array_sort(F.collect_list(F.struct("lang", "value"))).alias("s"))
    return grouped.select("tag", F.to_json(F.map_from_entries("s"), {"ignoreNullFields": "false"}).alias("names"))


def export_display_names(names: DataFrame, path: str) -> None:
    display_name_rows(names).write.mode("overwrite").json(path)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system knows it, if it lies in a folder of the machine (one that all executors share), else None."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def write_folders(lines: DataFrame, root: str, ending: str) -> int:
    """(batch, value) as lines of a text file in a folder for each batch of ``root``, a folder of the machine, which is emptied first; returns the number of files.

    Hadoop's writer starts some five processes of the system for each file in a folder of the machine, unless its native library is
    there; with a folder for every few rows, that is nearly all the work. So tasks write their files themselves: a task one file to
    each of its batches, under a name that hangs on the task's number alone and in one rename, so a repeated task leaves the same.
    """

    def put(parts):
        import pyarrow as pa
        from pyspark import TaskContext

        task, files, batch, out = TaskContext.get(), 0, ..., None
        name, temp = f"part-{task.partitionId():05d}.{ending}", f"_part-{task.taskAttemptId()}"

        def close():
            out.close()
            os.replace(out.name, os.path.join(os.path.dirname(out.name), name))

        for part in parts:
            for b, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if b != batch:
                    if out:
                        close()
                    folder = os.path.join(root, f"batch={'__HIVE_DEFAULT_PARTITION__' if b is None else b}")
                    os.makedirs(folder, exist_ok=True)
                    batch, files, out = b, files + 1, open(os.path.join(folder, temp), "w", encoding="utf-8", newline="\n")
                out.write((value or "") + "\n")
        if out:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    if any(f.removeprefix("file://").startswith(f"{root}/") for f in lines.inputFiles()):
        raise ValueError(f"{root} is read by what is to be written there")
    p = lines.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{root}")
    p.getFileSystem(lines.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    os.makedirs(root, exist_ok=True)
    sorted_ = lines.select("batch", "value").withColumn("_at", F.monotonically_increasing_id()).sortWithinPartitions("batch", "_at").drop("_at")
    files = sorted_.mapInArrow(put, "files long").agg(F.coalesce(F.sum("files"), F.lit(0)).alias("n")).first().n  # one row
    open(os.path.join(root, "_SUCCESS"), "w").close()
    return files


def folders_of(df: DataFrame, path: str) -> str | None:
    """The folder to which write_folders can write the batches of ``df``, else None."""
    return mounted(df.sparkSession, path) if isinstance(df.schema["batch"].dataType, IntegralType) else None


def write_batches(numbered: DataFrame, path: str) -> None:
    """A folder for each batch; former ones go."""
    if root := folders_of(numbered, path):
        write_folders(numbered.select("batch", F.to_json(F.struct(*[c for c in numbered.columns if c != "batch"])).alias("value")), root, "json")
    else:
        numbered.write.mode("overwrite").options(**MANY_FILES).partitionBy("batch").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """(batch, value) as text, a folder for each batch; former ones go."""
    if root := folders_of(lines, path):
        write_folders(lines, root, "txt")
    else:
        lines.write.mode("overwrite").options(**MANY_FILES).partitionBy("batch").text(path)


def write_layer(existing: DataFrame, accepted: DataFrame, path: str, prefer: str = "accepted", apply: bool = False) -> DataFrame:
    """The merged layer; written only with ``apply``, to another path than it is read from."""
    merged = merge_layer(existing, accepted, prefer)
    if apply:
        merged.write.mode("overwrite").parquet(path)
    return merged


def artifact_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(name, rows, bytes) of Parquet tables."""
    out = None
    for name, path in paths.items():
        rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
        sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length").alias("bytes"))
        part = rows.crossJoin(sizes).select(F.lit(name).alias("name"), "rows", "bytes")  # one row each
        out = part if out is None else out.unionByName(part)
    return out
