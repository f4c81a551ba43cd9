"""Small files and folders on whatever store Spark reaches, from the driver."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE, HELD = 1 << 20, 32 << 20  # bytes of a file in a row, and of all files that the driver takes at once


def path_of(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def store_of(spark: SparkSession, path: str):
    return path_of(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    store = store_of(spark, folder)
    if not store.exists(path_of(spark, folder)):
        return []
    return sorted(entry.getPath().getName() for entry in store.listStatus(path_of(spark, folder)))


def read_bytes(spark: SparkSession, path: str) -> bytes:
    stream = store_of(spark, path).open(path_of(spark, path))
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    stream = store_of(spark, path).create(path_of(spark, path), True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def write_files(files: DataFrame, folder: str) -> None:
    """Put ``(path, content)`` or ``(path, place, piece)`` into a folder as files, one after the other, in pieces: no file is whole on the driver."""
    spark, size = files.sparkSession, PIECE

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                whole = content.as_buffer()
                for place, start in enumerate(range(0, max(whole.size, 1), size)):
                    piece = whole.slice(start, min(size, whole.size - start)).to_pybytes()
                    columns = [pa.array([path.as_py()]), pa.array([place]), pa.array([piece], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "place", "piece"])

    held = "piece" if "piece" in files.columns else "content"
    total = files.agg(F.sum(F.octet_length(held))).first()[0] or 0
    pieces = files if held == "piece" else files.select("path", "content").mapInArrow(cut, "path string, place long, piece binary")
    dealt = pieces.repartitionByRange(total // HELD + 1, "path", "place").sortWithinPartitions("path", "place")
    for path, rows in groupby(dealt.toLocalIterator(), key=lambda row: row["path"]):
        target = f"{folder}/{path}"
        stream = store_of(spark, target).create(path_of(spark, target), True)
        try:
            for row in rows:
                stream.write(row["piece"])
        finally:
            stream.close()


def write_at_once(spark: SparkSession, path: str, data: bytes) -> None:
    """A new file that readers see whole or not at all: written aside and renamed. An existing one is an error."""
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/_writing-{name}"
    write_bytes(spark, aside, data)
    store = store_of(spark, path)
    if store.exists(path_of(spark, path)) or not store.rename(path_of(spark, aside), path_of(spark, path)):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    store_of(spark, path).delete(path_of(spark, path), True)
