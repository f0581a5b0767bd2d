"""Incremental ingest: slices of posts become partial cells, each slice visible whole or not at all.

A slice writes its cells, then its totals, then an empty marker, by which alone readers know it. So a slice that was
killed half way shows nothing, and its repetition writes it anew. Slices are merged by levels: every ``FAN`` neighbouring runs of
a level become one of the next, committed the same way, so that after n slices a reader meets fewer than FAN * log(n) runs.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import FIRST_DAY, cells_of_names, live_posts, name_cells, next_id, with_day
from ..operators.series import merge_cells
from ..sources.readers import exists
from .ranges import id_ranges

NAME_CELLS = "name string, day date, posts long, fav_sum long, score_sum long"
TOTALS = "day date, posts long, fav_sum long, score_sum long"
FAN = 10


def guard_settings(spark: SparkSession, out: str, settings: dict) -> None:
    """Refuses to go on with other settings than the output was begun with."""
    text, path = json.dumps(settings, sort_keys=True), f"{out}/settings"
    if exists(spark, path):
        was = spark.read.text(path).first()[0]
        if was != text:
            raise ValueError(f"output was begun with {was}, not {text}")
    else:
        spark.range(1).select(F.lit(text).alias("value")).write.text(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


# --- runs: a run covers slices lo to hi - 1; batch=n is one slice, merge=lo-hi several


def run_name(lo: int, hi: int) -> str:
    return f"batch={lo}" if hi == lo + 1 else f"merge={lo}-{hi}"


def committed(spark: SparkSession, out: str) -> set[tuple[int, int]]:
    """The committed runs, by the names of their markers."""
    if not exists(spark, f"{out}/done"):
        return set()
    fs, p = _hadoop(spark, f"{out}/done")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = [re.fullmatch(r"(?:batch=(\d+)|merge=(\d+)-(\d+))", n) for n in names]
    return {(int(m[1]), int(m[1]) + 1) if m[1] else (int(m[2]), int(m[3])) for m in found if m}


def cover(runs: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The fewest runs that hold each committed slice once. Runs nest, since merges are aligned."""
    out, end = [], -1
    for lo, hi in sorted(runs, key=lambda r: (r[0], -r[1])):
        if lo >= end:
            out.append((lo, hi))
            end = hi
    return out


def write_part(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def commit_run(spark: SparkSession, out: str, lo: int, hi: int, cells: DataFrame, totals: DataFrame) -> None:
    """Writes a run's two tables, then its marker; until then nothing of it is read."""
    name = run_name(lo, hi)
    write_part(cells, f"{out}/cells/{name}")
    write_part(totals, f"{out}/totals/{name}")
    fs, p = _hadoop(spark, f"{out}/done/{name}")
    fs.create(p, True).close()


def read_runs(spark: SparkSession, out: str, runs: list[tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """(cells by raw name, totals) of ``runs``."""
    read = lambda t, schema: spark.read.schema(schema).parquet(*[f"{out}/{t}/{run_name(*r)}" for r in runs]) if runs else spark.createDataFrame([], schema)
    return read("cells", NAME_CELLS), read("totals", TOTALS)


def compact(spark: SparkSession, out: str, fan: int = FAN) -> None:
    """Merges every ``fan`` neighbouring runs of equal size, level by level. What was merged stays until ``expire``."""
    done, size = committed(spark, out), fan
    while any(hi - lo == size // fan for lo, hi in done):
        part = size // fan
        for lo in sorted({lo - lo % size for lo, hi in done if hi - lo == part}):
            inner = [(x, x + part) for x in range(lo, lo + size, part)]
            if (lo, lo + size) not in done and all(r in done for r in inner):
                cells, totals = read_runs(spark, out, inner)
                commit_run(spark, out, lo, lo + size, merge_cells(cells, ["name", "day"]), merge_cells(totals, ["day"]))
                done.add((lo, lo + size))
        size *= fan


def expire(spark: SparkSession, out: str) -> None:
    """Deletes runs that larger ones hold, when no reader uses them any more. Their markers stay, so that no slice comes twice."""
    done = committed(spark, out)
    for lo, hi in done - set(cover(done)):
        for t in ("cells", "totals"):
            fs, p = _hadoop(spark, f"{out}/{t}/{run_name(lo, hi)}")
            fs.delete(p, True)


def _slice(posts: DataFrame, out: str, n: int, first_day: str, options: dict, fan: int) -> None:
    spark = posts.sparkSession
    if (n, n + 1) not in committed(spark, out):
        dated = with_day(live_posts(posts, **options), first_day).persist()
        sums = dated.groupBy("day").agg(F.count("*").alias("posts"), F.sum("fav").alias("fav_sum"), F.sum("score").alias("score_sum"))
        # each post becomes a cell for each of its tags, which a task gathers: as many posts a task as a scan reads would be too many
        commit_run(spark, out, n, n + 1, name_cells(dated.hint("rebalance")), sums)
        dated.unpersist()
    if (n + 1) % fan == 0:
        compact(spark, out, fan)


def ingest(posts: DataFrame, out: str, checkpoint: str, settings: dict | None = None, first_day: str = FIRST_DAY, fan: int = FAN, **options) -> None:
    """Runs a stream of posts to its end. A slice that is committed is not written again, so a repeated one adds nothing.

    Partial cells are kept by raw tag name: aliases are resolved when they are merged, so a change of aliases
    needs no new scan. Output and checkpoint belong together and are deleted together.
    """
    guard_settings(posts.sparkSession, out, settings or {})
    each = lambda batch, n: _slice(batch, out, n, first_day, options, fan)
    posts.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_ranges(posts: DataFrame, out: str, checkpoint: str, chunk_size: int = 500_000, settings: dict | None = None, first_day: str = FIRST_DAY, max_id: int | None = None, fan: int = FAN, **options) -> None:
    """As ingest, of a table of posts in slices of ``chunk_size`` ids, up to ``max_id`` (by default the table's next id).

    A later run goes on at the id at which the last one ended: rows that came meanwhile under lower ids are not read, and
    none is read twice.
    """
    spark = posts.sparkSession
    guard_settings(spark, out, {**(settings or {}), "chunk_size": chunk_size})
    bound = next_id(posts).first().max_id if max_id is None else max_id  # one row

    def each(batch: DataFrame, n: int) -> None:
        span = batch.first()  # one row, from the source's offsets
        if span is not None:
            _slice(posts.where(F.col("id").between(span.lo, span.hi - 1)), out, n, first_day, options, fan)

    query = id_ranges(spark, bound, chunk_size).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def merged(spark: SparkSession, out: str, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(daily cells, daily totals) of all committed slices."""
    cells, totals = read_runs(spark, out, cover(committed(spark, out)))
    return cells_of_names(cells, lookup), merge_cells(totals, ["day"])
