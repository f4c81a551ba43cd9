"""Exact n-gram Jaccard self-join by PartEnum signatures.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct word
shingles. The method:

* Set sizes are cut into bands ``[l, r]`` with ``r = floor(100 l / percent)``; the sizes of a linked
  pair lie in the same or in neighbouring bands. Instance ``i`` serves the pairs with a set in band
  ``i`` and the other in band ``i`` or ``i + 1``; their symmetric difference is at most ``k``.
* An instance cuts the feature domain into ``n1 > k / 2`` parts of three cells each. At most ``k``
  features differ, so some part has at most one differing cell: the sets agree on two of its three
  cells. Each pair of cells of each part is a signature (the subsets that PartEnum enumerates).
* Agreement on empty cells says nothing and would be a hot key. A set with more than ``k / 2`` parts
  in which at least two cells hold something shares a signature that is not empty, so it sends
  only those; only sets without that property also send their empty ones. No link is lost.

Identical sets are one node from the start, so copies never meet as pairs. What shares a signature is
compared and verified as ``signatures`` says, on the full sets at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import bitmap as bm
from tidegate.llm import signatures as sg
from tidegate.llm.common import keeps_columns, mixed, partitions, released, shingle_sets, text_runs, written
from tidegate.llm.components import components

WORDS, PERCENT = 5, 75
CHARS_A_BUCKET = 10_000_000  # about 2 million signatures
_U = np.uint64


def bands(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = [1], [100 // percent]
    while high[-1] < largest:
        low.append(high[-1] + 1)
        high.append(max(low[-1], 100 * low[-1] // percent))
    low.append(high[-1] + 1)
    high.append(max(low[-1], 100 * low[-1] // percent))
    return np.array(low), np.array(high)


def digests(of: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit name for each set."""
    total = np.concatenate(([_U(0)], np.cumsum(mixed(hashes), dtype=np.uint64)))
    ends = np.cumsum(sizes)
    return mixed(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


def signatures(of, hashes, sizes, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(set, signature) pairs of both instances that a set takes part in."""
    if not len(of):
        return
    low, high = bands(int(sizes.max()), percent)
    band = np.searchsorted(low, sizes, side="right") - 1
    for step in (0, 1):
        instance = band - step
        top = high[np.maximum(instance, 0)]
        k = sg.difference(top, np.minimum(100 * top // percent, high[np.maximum(instance, 0) + 1]), percent)
        live = (instance >= 0) & (sizes > 0) & (k > 0)  # k = 0: only identical sets, which are one node
        partner = 100 * sizes // percent if step == 0 else top
        own = np.minimum(k, sg.difference(sizes, partner, percent))
        n1 = np.where(live, np.ceil(1.2 * (k // 2 + 1)).astype(np.int64), 0)
        base = np.cumsum(3 * n1) - 3 * n1
        total = int((3 * n1).sum())
        if not total:
            continue
        use = live[of]
        o, seed = of[use], (instance[of[use]] + 1).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
        m = mixed(hashes[use] + seed)
        cell = base[o] + ((m >> _U(12)) % (3 * n1[o]).astype(np.uint64)).astype(np.int64)
        g = mixed(m)
        count = np.bincount(cell, minlength=total)
        value = np.bincount(cell, (g & _U(0x3FFFFFF)).astype(float), total).astype(np.uint64)
        value += np.bincount(cell, (g >> _U(38)).astype(float), total).astype(np.uint64) * _U(1 << 32)
        value, full = mixed(value).reshape(-1, 3), (count > 0).reshape(-1, 3)
        value[~full] = 0
        of_part = np.repeat(np.arange(len(n1)), n1)
        strong = np.bincount(of_part[full.sum(1) >= 2], minlength=len(n1))
        empties = strong <= own // 2
        name = mixed((np.arange(len(of_part)) - (base // 3)[of_part]).astype(np.uint64) * _U(4)
                     + (instance[of_part] + 1).astype(np.uint64) * _U(1 << 40))
        for left, right in ((0, 1), (0, 2), (1, 2)):
            send = full[:, left] | full[:, right] | empties[of_part]
            sig = mixed(mixed(name + _U(left * 3 + right)) + value[:, left] * _U(3) + mixed(value[:, right]))
            yield of_part[send], sig[send]


def _sets(batch: pa.RecordBatch, words: int):
    """Runs of the batch: (rows, sizes, set of each shingle, shingle)."""
    for begin, _, texts in text_runs(batch.column(batch.schema.get_field_index("text"))):
        for rows, of, hashes in shingle_sets(texts, words):
            sizes = np.bincount(of, minlength=rows.stop - rows.start)
            yield slice(begin + rows.start, begin + rows.stop), sizes, of, hashes


def with_sets(docs: DataFrame, id_column: str, words: int = WORDS) -> DataFrame:
    """``doc_id, row, n_shingles, node``: the size of each set and its 64-bit name (null if empty)."""

    def measure(batches):
        for batch in batches:
            for rows, sizes, of, hashes in _sets(batch, words):
                node = pa.array(digests(of, hashes, sizes), mask=sizes == 0)
                own = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(sizes), node], ["doc_id", "row", "n_shingles", "node"]
                )

    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text")
    )
    return source.mapInArrow(released(measure), "doc_id long, row long, n_shingles long, node long")


def _packed(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    def pack(batches):
        for batch in batches:
            for _, sizes, of, hashes in _sets(batch, words):
                found = list(signatures(of, hashes, sizes, percent))
                if found:
                    owner, sig = (np.concatenate(x) for x in zip(*found))
                    yield from sg.packed(digests(of, hashes, sizes), owner, sig, buckets)

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(released(pack), sg.PACKED)


def _wanted_sets(docs: DataFrame, id_column: str, wanted: DataFrame, words: int, whole: bool) -> DataFrame:
    """``node, size, data`` for the nodes of ``wanted``, from the text of their smallest document (``rep``)."""
    held = bm.bitmap(wanted.select(F.coalesce("rep", F.lit(0)).alias("rep")), "rep")

    def measure(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(0))
            batch = batch.take(pa.array(np.flatnonzero(bm.holds(held, ids))))
            for _, sizes, of, hashes in _sets(batch, words):
                yield sg.described(digests(of, hashes, sizes), of, hashes, whole)

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return sg.once(source.mapInArrow(released(measure), sg.DESCRIBED), wanted)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, row, n_shingles, node, n_copies, group, component_id`` for every row of ``docs`` (needs ``text``).

    ``component_id`` is the smallest id reachable by links, its own included; ``group`` is alike for
    just these rows (null without words), ``row`` a hash of the text. Null or wordless texts: 0
    shingles, linked with nothing. Fewer words than a shingle: the whole sequence is the one shingle.
    Texts with equal sets, repeated rows too, are one node (``n_copies`` rows have it). A null id is
    never the smallest; where all are null, so is the component's. Other columns are ignored.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    measured = written(with_sets(docs, id_column, words), "sets")
    reps = written(measured.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")
    ), "nodes")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(partitions(spark), -(-chars // CHARS_A_BUCKET))
    lists = written(sg.lists_of(_packed(docs, words, percent, buckets)), "lists")

    def sets_of(wanted: DataFrame, whole: bool) -> DataFrame:
        named = written(wanted.join(reps.select("node", "rep"), "node"), "wanted")
        return _wanted_sets(docs, id_column, named, words, whole)

    joined = components(sg.linked(lists, sets_of, percent)).withColumnRenamed("component", "group")
    smallest = reps.join(joined, "node").groupBy("group").agg(F.min("rep").alias("least"))
    classes = reps.join(joined.join(smallest, "group"), "node", "left").select(
        "node", "n_copies", F.coalesce("group", "node").alias("group"), F.coalesce("least", "rep").alias("least")
    )
    out = measured.join(classes, "node", "left")
    return out.select(
        "doc_id", "row", "n_shingles", "node", F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "group",
        F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


@keeps_columns("_row", "_maybe", "_d", "_r")
def deduplicated(docs: DataFrame, id_column: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null last), then text hash.

    Rows without words are in no group and all stay. Of rows alike in id and text one stays.
    """
    rows = written(near_duplicates(docs, id_column, words, percent).select("doc_id", "row", "group"), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    stays = rows.where("group is not null").groupBy("group").agg(F.min(place).alias("stays"))
    ranked = rows.join(stays, "group").withColumn("place", place)
    goes = ranked.where(F.col("place") != F.col("stays")).select("doc_id", "row")
    repeated = ranked.where(F.col("place") == F.col("stays")).groupBy("doc_id", "row").count().where("count > 1")
    left = bm.without(docs, written(goes, "goes"), id_column)
    repeated = written(repeated.select("doc_id", "row"), "repeated")
    single, likely = bm.split_off(left, repeated, id_column)
    alike = repeated.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"))
    again = likely.join(alike, bm.same_row(id_column), "left_semi").dropDuplicates([id_column, "_row"])
    others = likely.join(alike, bm.same_row(id_column), "left_anti")
    return single.unionByName(others).unionByName(again).select(docs.columns)
