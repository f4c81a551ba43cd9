"""A fixed-size set of keys that tasks can test locally before an exact join.

The bitmap has 2^23 bits (1 MiB) whatever the number of keys, so sending it to every task is
bounded. It only ever lets too many rows through, never too few: the join that follows decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import mixed, released

BITS = 23


def places(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """``bool`` per place; at most 2^17 words of 64 bits reach the driver."""
    import pyarrow as pa

    def put(batches):
        held = np.zeros(1 << BITS, bool)
        for batch in batches:
            values = batch.column(0)
            held[places(np.asarray(values.drop_null()))] = True
        words = np.packbits(held, bitorder="little").view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], ["place", "bits"])

    parts = keys.select(F.col(column).cast("long").alias("key")).mapInArrow(released(put), "place long, bits long")
    rows = parts.groupBy("place").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[rows["place"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return np.packbits(np.unpackbits(words.view(np.uint8), bitorder="little")).view(np.uint8)


def holds(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = places(keys)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def split_off(docs: DataFrame, named: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``_row`` (a hash of the text) in two parts: rows that ``named`` (``doc_id, row``) surely does not
    hold, and the few others, which an exact join has to decide. So texts that stay are not dealt out."""
    held = bitmap(named, "row")

    @F.pandas_udf("boolean")
    def maybe(rows: pd.Series) -> pd.Series:
        return pd.Series(holds(held, rows.to_numpy(np.int64)))

    marked = docs.withColumn("_row", F.xxhash64("text"))
    marked = marked.withColumn("_maybe", maybe(F.col("_row")))
    return marked.where("not _maybe").drop("_maybe"), marked.where("_maybe").drop("_maybe")


def same_row(id_column: str):
    """``doc_id, row`` as ``_d, _r`` name the row of a document."""
    return F.col("_d").eqNullSafe(F.col(id_column).cast("long")) & (F.col("_r") == F.col("_row"))


def without(docs: DataFrame, named: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that ``named`` (``doc_id, row``) holds."""
    stay, likely = split_off(docs, named, id_column)
    goes = named.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r")).distinct()
    return stay.unionByName(likely.join(goes, same_row(id_column), "left_anti")).select(docs.columns)
