"""Results of deliveries that replace those of earlier ones, all at once.

Each batch writes its results into folders of its own, ``<table>/batch=<name>``, which never change. Which batch
holds the current results of a bundle stands in a keyed table, ``current``: putting its next version in place shows the new
results of all tables, and takes away the old ones, in one rename. A bundle without a batch is withdrawn. Readers
join a table with ``current``, so what a failed batch has left behind is never seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources import files
from tidegate.sources.keyed import KeyedTable, later


def current(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root.rstrip('/')}/current", "bundle")


def stage(df: DataFrame, root: str, table: str, batch: str, together: bool = False) -> DataFrame:
    """Write one table of a batch, whose rows carry ``bundle``; nobody sees it before the batch is committed.

    ``together`` tells that the rows of a bundle follow each other in a partition as they come, so that none are sorted.
    """
    path = f"{root.rstrip('/')}/{table}/batch={batch}"
    (df if together else df.sortWithinPartitions("bundle")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def committed(spark: SparkSession, root: str, batch: str) -> bool:
    return any(name == batch for _, name in current(spark, root).versions())


def commit(spark: SparkSession, root: str, bundles: DataFrame, batch: str, order: str | None = None) -> bool:
    """Make a batch the current one of its ``bundles``; False if it has been committed before.

    With ``order``, a column of ``bundles``, a delivery that is older than the current one of its bundle changes
    nothing. ``withdrawn``, if it is a column, marks bundles that have no results any more.
    """
    gone = F.col("withdrawn") if "withdrawn" in bundles.columns else F.lit(False)
    holder = F.when(~F.coalesce(gone, F.lit(False)), F.lit(batch)).alias("batch")
    if order is None:
        return current(spark, root).merge(batch, bundles.select("bundle", holder).groupBy("bundle").agg(F.max("batch").alias("batch")))
    rows = bundles.select("bundle", holder, F.col(order).alias("delivered"))
    last = rows.groupBy("bundle").agg(F.max_by(F.struct("batch", "delivered"), "delivered").alias("r")).select("bundle", "r.*")
    return current(spark, root).merge(batch, last, later("bundle", "delivered"))


def withdraw(spark: SparkSession, root: str, bundles: DataFrame, batch: str) -> bool:
    """Take away all results of the bundles."""
    return commit(spark, root, bundles.select("bundle", F.lit(True).alias("withdrawn")), batch)


def read(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The current rows of a table as one snapshot, or None if nothing has been committed."""
    holders = current(spark, root).read()
    if holders is None or not any(n.startswith("batch=") for n in files.names(spark, f"{root.rstrip('/')}/{table}")):
        return None
    rows = spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{table}")
    held = holders.where("batch is not null").select("bundle", "batch")
    return rows.join(held, ["bundle", "batch"], "left_semi").drop("batch")


def clear(spark: SparkSession, root: str, tables: tuple[str, ...]) -> None:
    """Remove the folders of batches that hold no bundle's current results; run it while no reader is at work."""
    holders = current(spark, root).read()
    if holders is None:
        return
    live = {f"batch={r.batch}" for r in holders.select("batch").where("batch is not null").distinct().toLocalIterator()}
    for table in tables:
        for name in files.names(spark, f"{root.rstrip('/')}/{table}"):
            if name.startswith("batch=") and name not in live:
                files.remove(spark, f"{root.rstrip('/')}/{table}/{name}")
