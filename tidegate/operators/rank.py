"""Dense rank inside a bundle without sorting a whole bundle in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions import text
from tidegate.runtime import shared_dir


def sample_dense_rank(df: DataFrame, id_column: str = "meetwaarde_lokaalid", ranges: int | None = None) -> DataFrame:
    """Dense rank of the stripped id among the ids of its bundle, for every distinct id.

    The distinct ids are range-partitioned and checkpointed, which fixes who sits where.
    Ids are numbered inside each range only; a range then starts where the earlier ranges
    of its bundle end. Bundles are contiguous in the ranges, so there are at most
    (ranges + bundles) offsets, and no window ever holds more than one range.
    """
    spark = df.sparkSession
    shared_dir(spark)
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = df.select("bundle", text.strip_prefix(id_column).alias("record_id")).where(
        F.col("record_id").isNotNull()
    )
    placed = ids.distinct().repartitionByRange(parts, "bundle", "record_id").checkpoint()
    placed = placed.withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range", "bundle").orderBy("record_id")
    numbered = placed.withColumn("_place", F.row_number().over(inside))

    sizes = placed.groupBy("bundle", "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("bundle").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "bundle", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return numbered.join(offsets, ["bundle", "_range"]).select(
        "bundle", "record_id", (F.col("_offset") + F.col("_place")).alias("recordnr_monster")
    )
