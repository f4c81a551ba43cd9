"""Tables with a key that batches update: a batch writes the buckets that it touches, and one rename makes it visible.

Rows lie in buckets by the hash of their key. A version is a small file that names the folder of each bucket; a
batch reads the buckets of its keys, writes them anew into a folder of its own and then puts the next version beside the
last one. Until then readers see the table as it was, and what a failed batch has written is in no version. A batch that
is repeated after its version is there does nothing. Of two writers that build on the same version the second is refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.sources import files

BUCKETS = 64
KEPT = 2  # versions that stay, with their folders, for readers that have begun

Combine = Callable[[DataFrame, DataFrame], DataFrame]


class KeyedTable:
    """The table below ``root`` whose rows are found by the column ``key``."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    def versions(self) -> list[tuple[int, str]]:
        """(number, name of the batch that made it) of the versions that are there, oldest first."""
        numbers = [int(n) for n in files.names(self.spark, f"{self.root}/versions") if n.isdigit()]
        return [(n, self._version(n)["batch"]) for n in numbers]

    def _version(self, number: int) -> dict:
        return json.loads(files.read_bytes(self.spark, f"{self.root}/versions/{number:09d}"))

    def _rows(self, version: dict, buckets: list[str]) -> DataFrame:
        schema = StructType.fromJson(version["schema"])
        paths = [f"{self.root}/data/{version['buckets'][b]}/bucket={b}" for b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame | None:
        """The newest version, or None if there is none. It stays the same whatever is written meanwhile."""
        versions = self.versions()
        if not versions:
            return None
        version = self._version(versions[-1][0])
        return self._rows(version, sorted(version["buckets"]))

    def merge(self, batch: str, updates: DataFrame, combine: Combine | None = None) -> bool:
        """Apply a batch of rows; False if that batch has been applied before.

        ``combine(current, updates)`` makes the new rows of the touched buckets; by default rows of ``updates``
        replace those of their keys.
        """
        versions = self.versions()
        if any(name == batch for _, name in versions):
            return False
        incoming = f"{self.root}/incoming/{batch}"
        updates.write.mode("overwrite").parquet(incoming)
        updates = self.spark.read.schema(updates.schema).parquet(incoming)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("string")
        touched = sorted(r[0] for r in updates.select(bucket).distinct().collect())  # no more than there are buckets

        last = self._version(versions[-1][0]) if versions else {"buckets": {}, "schema": updates.schema.jsonValue()}
        current = self._rows(last, [b for b in touched if b in last["buckets"]])
        merged = (combine or self._replaced)(current, updates)
        number = versions[-1][0] + 1 if versions else 0
        folder = f"{number:09d}-{batch}"
        merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        made = {n.removeprefix("bucket=") for n in files.names(self.spark, f"{self.root}/data/{folder}") if n.startswith("bucket=")}
        buckets = {b: f for b, f in last["buckets"].items() if b not in touched} | {b: folder for b in made}
        version = {"batch": batch, "schema": merged.schema.jsonValue(), "buckets": buckets}
        files.write_at_once(self.spark, f"{self.root}/versions/{number:09d}", json.dumps(version).encode())
        self._clear(incoming)
        return True

    def _replaced(self, current: DataFrame, updates: DataFrame) -> DataFrame:
        kept = current.join(updates.select(self.key).distinct(), self.key, "left_anti")
        return kept.unionByName(updates, allowMissingColumns=True)

    def _clear(self, incoming: str) -> None:
        """Remove old versions, and folders that no version names."""
        files.remove(self.spark, incoming)
        versions = self.versions()
        for number, _ in versions[:-KEPT]:
            files.remove(self.spark, f"{self.root}/versions/{number:09d}")
        named = {f for number, _ in versions[-KEPT:] for f in self._version(number)["buckets"].values()}
        last = f"{versions[-1][0]:09d}"
        for folder in files.names(self.spark, f"{self.root}/data"):
            if folder not in named and folder[:9] <= last:
                files.remove(self.spark, f"{self.root}/data/{folder}")


def later(key: str, order: str) -> Combine:
    """Of the old and the new rows of a key the one with the largest ``order`` stays, in whatever batch it came."""

    def combine(current: DataFrame, updates: DataFrame) -> DataFrame:
        rows = current.unionByName(updates, allowMissingColumns=True)
        payload = [c for c in rows.columns if c != key]
        return rows.groupBy(key).agg(F.max_by(F.struct(*payload), order).alias("_row")).select(key, "_row.*")

    return combine
