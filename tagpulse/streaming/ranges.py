"""A streaming source of id ranges: its offsets are ids, a batch is the next ``chunk_size`` of them below a bound.

The source says which ids come next; the rows themselves are read by Spark, from whatever holds them, with the range as a
filter that reaches the scan.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the source runs in a Python process of its own


class IdRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "id_ranges"

    def schema(self) -> str:
        return "lo long, hi long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return IdRangeReader(*(int(self.options[k]) for k in ("first", "bound", "chunk_size")))


class IdRangeReader(SimpleDataSourceStreamReader):
    def __init__(self, first: int, bound: int, chunk_size: int):
        if chunk_size < 1:
            raise ValueError("chunk_size must be 1 or more")
        self.first, self.bound, self.chunk_size = first, bound, chunk_size

    def initialOffset(self) -> dict:  # noqa: N802
        return {"id": self.first}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        lo = start["id"]
        hi = min(lo + self.chunk_size, self.bound)
        return (iter([(lo, hi)]), {"id": hi}) if lo < hi else (iter([]), start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter([(start["id"], end["id"])] if start["id"] < end["id"] else [])


def id_ranges(spark: SparkSession, bound: int, chunk_size: int, first: int = 0) -> DataFrame:
    """A stream of (lo, hi), one row a batch."""
    spark.dataSource.register(IdRanges)
    return spark.readStream.format("id_ranges").options(first=first, bound=bound, chunk_size=chunk_size).load()
