"""Pages of a sorted table, of which each reads only the ranges that it lies in."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.runtime import scratch_path


class Pages:
    """A table sorted once into ranges, written with a folder for each; ``page`` gives any page of it.

    The driver holds one count for each range. A page sorts the rows of the ranges it lies in, usually one, wherever
    in the table it is; a page past the end is empty.
    """

    def __init__(self, df: DataFrame, sort_by: str, descending: bool = False, ties: tuple[str, ...] = (), ranges: int | None = None) -> None:
        first = F.col(sort_by).desc() if descending else F.col(sort_by).asc()
        self.order = [first, *(F.col(c).asc() for c in ties if c != sort_by)]
        spark = df.sparkSession
        parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(spark, "pages")
        dealt = df.repartitionByRange(parts, *self.order).withColumn("_range", F.spark_partition_id())
        dealt.write.partitionBy("_range").parquet(path)
        self.table = spark.read.schema(dealt.schema).parquet(path)
        counted = self.table.groupBy("_range").agg(F.count("*").alias("n")).collect()
        self.ranges = sorted(r["_range"] for r in counted)
        size = {r["_range"]: r["n"] for r in counted}
        self.ends = list(accumulate(size[r] for r in self.ranges))

    @property
    def rows(self) -> int:
        return self.ends[-1] if self.ends else 0

    def page(self, number: int, size: int = 10) -> DataFrame:
        begin = min(max(number, 0) * size, self.rows)
        first = bisect_right(self.ends, begin)
        last = min(bisect_right(self.ends, max(begin, begin + size - 1)), len(self.ranges) - 1)
        own = self.ranges[first : last + 1]
        before = self.ends[first - 1] if first else 0
        inside = self.table.where(F.col("_range").isin(own)).orderBy(*self.order).offset(begin - before).limit(size)
        return inside.drop("_range")

    def last(self, size: int = 10) -> DataFrame:
        return self.page(max(0, self.rows - 1) // size, size)
