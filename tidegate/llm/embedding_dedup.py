"""Near-duplicate vectors by counting collisions on sorted one-dimensional projections.

The directions are the signed sums of any two of ``base`` random Gaussian directions, millions in
all, of which only the far tails are looked at: a vector takes part in the ``kept`` directions on which
it lies furthest out, and those are found among the sums of its ``top`` base projections. Far out
few vectors lie, and near vectors lie there together. Every direction's values are sorted, and each
vector opens a window around its own value: the vectors inside collide with it. Pairs with at least
as many collisions as calibrated are verified by their cosine.

The count is calibrated for recall: random pairs at exactly the wanted cosine are projected on the
same directions, and the largest count that at least ``recall`` of them reach is taken. Because the
base is Gaussian, a pair's collisions depend on its angle alone, not on the corpus, so this holds
for every table of that width; nearer pairs collide more often.

A vector's chance collisions fall with the square of ``base``, so a larger corpus takes a larger base. Equal vectors are one node from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import mixed, partitions, written
from tidegate.llm.components import components

COSINE = 0.9
BASE, TOP, KEPT, RECALL, SEED = 2048, 18, 80, 0.995, 7
WINDOW = 2.5  # half width, in standard deviations of the projected difference of a pair at the cosine
SAMPLE = 4000  # pairs that the count is calibrated on
BLOCK = 128


def directions(width: int, number: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, width]).standard_normal((width, number)).astype(np.float32)


def half_width(cosine: float) -> float:
    return WINDOW * float(np.sqrt(max(2 - 2 * cosine, 0)))


def outermost(units: np.ndarray, lines: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """(direction, value) of the ``kept`` largest projections of each row on signed sums of two base directions."""
    base = units.astype(np.float32) @ lines
    top = min(TOP, base.shape[1])
    at = np.sort(np.argpartition(-np.abs(base), top - 1, axis=1)[:, :top], axis=1)
    found = np.take_along_axis(base, at, 1)
    name, size = at * 2 + (found < 0), np.abs(found)
    i, j = np.triu_indices(top, 1)
    line, value = name[:, i] * (4 * lines.shape[1]) + name[:, j], (size[:, i] + size[:, j]) / np.float32(2**0.5)
    far = np.argpartition(-value, min(kept, value.shape[1]) - 1, axis=1)[:, :kept]
    return np.take_along_axis(line, far, 1), np.take_along_axis(value, far, 1)


def calibrated(width: int, number: int, kept: int, cosine: float, recall: float, sample: int = SAMPLE) -> int:
    """The largest count that ``recall`` of random pairs at ``cosine`` reach, 1 at least."""
    rng, lines, reach = np.random.default_rng([SEED, 1]), directions(width, number), half_width(cosine)
    counts = []
    for _ in range(0, sample, BLOCK):
        a, b = rng.standard_normal((2, BLOCK, width))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(1, keepdims=True) * a
        b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        b = cosine * a + np.sqrt(max(1 - cosine**2, 0)) * b if width > 1 else a
        (da, va), (db, vb) = outermost(a, lines, kept), outermost(b, lines, kept)
        hit = (da[:, :, None] == db[:, None, :]) & (np.abs(va[:, :, None] - vb[:, None, :]) <= reach)
        counts.append(hit.sum((1, 2)))
    return max(1, int(np.quantile(np.concatenate(counts), 1 - recall, method="lower")))


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    number = vector.cast("array<double>")
    fine = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(number, lambda x: x != 0), F.lit(False))


def _collisions(entries: DataFrame, reach: float, buckets: int) -> DataFrame:
    """``a, b, n``: collisions of each pair, added up per bucket of directions before they are dealt out."""

    def scan(group: pa.Table) -> pa.Table:
        line, value, node = (np.asarray(group.column(c)) for c in ("line", "value", "node"))
        order = np.lexsort((node, value, line))
        line, value, node = line[order], value[order], node[order]
        # one increasing key over all lines: lines are further apart than any window
        step = float(value.max() - value.min()) + 2 * reach + 1 if len(value) else 1.0
        _, rank = np.unique(line, return_inverse=True)
        key = rank * step + value
        # each window reaches up only: the pair's other half is found from below
        stop = np.searchsorted(key, key + reach, side="right")
        n = stop - np.arange(len(key)) - 1
        out, begin = [], 0
        total = np.cumsum(n)
        while begin < len(key):  # a few million collisions at a time
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + 4_000_000)))
            left = np.repeat(np.arange(begin, end), n[begin:end])
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n[begin:end]) - n[begin:end], n[begin:end])
            a, b = node[left], node[right]
            pair = np.stack([np.maximum(a, b), np.minimum(a, b)], 1)
            out.append(_added(pair, np.ones(len(pair), np.int64)))
            if len(out) > 4:
                out = [_added(np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out]))]
            begin = end
        pair, count = _added(np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out]))
        return pa.table({"a": pair[:, 0], "b": pair[:, 1], "n": count})

    found = entries.withColumn("bucket", F.pmod(F.xxhash64("line"), F.lit(buckets)))
    found = found.groupBy("bucket").applyInArrow(scan, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _added(pair: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(pair):
        return pair, count
    order = np.lexsort((pair[:, 1], pair[:, 0]))
    pair, count = pair[order], count[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(1)])
    return pair[first], np.add.reduceat(count, first)


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE,
    number: int = BASE, kept: int = KEPT, recall: float = RECALL,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept, n_copies`` for every row.

    Links: cosine, computed in double precision, of ``cosine`` or more; none below it. A null, zero or
    empty vector, or one with a null or non-finite component, links with nothing. Vectors of different
    widths never link. Equal vectors, repeated rows too, are one node but each counts as a link
    of the others. A null id is never the smallest. Other columns are ignored; an empty table gives
    an empty result.
    """
    spark = vectors.sparkSession
    reach = half_width(cosine)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.when(usable(F.col(vector_column)), F.transform(F.col(vector_column).cast("array<double>"), lambda x: x + F.lit(0.0))).alias("vector"),
    )
    # -0.0 + 0.0 is 0.0, so equal vectors have equal text and one 128-bit name
    rows = rows.withColumn("name", F.when(F.col("vector").isNotNull(), F.md5(F.concat_ws(",", F.col("vector").cast("array<string>")))))
    nodes = written(
        rows.where("name is not null").groupBy("name").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("n_copies"), F.first("vector").alias("vector")
        ).withColumn("node", F.xxhash64("name")), "vectors",
    )
    widths = [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]  # one integer per width
    counts = {w: calibrated(w, number, kept, cosine, recall) for w in widths}

    def project(batches):
        lines = {}
        for batch in batches:
            node, vector = np.asarray(batch.column(0)), batch.column(1)
            sizes = np.diff(np.asarray(vector.offsets))
            for width in np.unique(sizes):
                if width not in lines:
                    lines[width] = directions(int(width), number)
                at = np.flatnonzero(sizes == width)
                units = np.asarray(vector.take(pa.array(at)).flatten()).reshape(-1, width)
                units = units / np.abs(units).max(1, keepdims=True)
                units /= np.linalg.norm(units, axis=1, keepdims=True)
                for s in range(0, len(at), BLOCK):
                    line, value = outermost(units[s : s + BLOCK], lines[width], kept)
                    n = line.shape[1]
                    name = mixed(line.ravel().astype(np.uint64) + np.uint64(int(width) << 32)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name), pa.array(value.ravel().astype(np.float64)), pa.array(np.repeat(node[at[s : s + BLOCK]], n)),
                         pa.array(np.full(len(name), width, np.int32))], ["line", "value", "node", "width"],
                    )

    entries = nodes.select("node", "vector").repartition(partitions(spark), "node").mapInArrow(
        project, "line long, value double, node long, width int"
    )
    pairs = _collisions(entries.select("line", "value", "node"), reach, 4 * partitions(spark))

    def verify(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            x, y = batch.column(2), batch.column(3)
            nx, ny = np.diff(np.asarray(x.offsets)), np.diff(np.asarray(y.offsets))
            for width in np.unique(nx):
                at = np.flatnonzero((nx == width) & (ny == width))
                u = np.asarray(x.take(pa.array(at)).flatten()).reshape(-1, width)
                v = np.asarray(y.take(pa.array(at)).flatten()).reshape(-1, width)
                u, v = (z / np.abs(z).max(1, keepdims=True) for z in (u, v))
                cos = (u * v).sum(1) / np.sqrt((u * u).sum(1) * (v * v).sum(1))
                keep[at] = cos >= cosine
            yield batch.select([0, 1]).filter(pa.array(keep))

    side = lambda n: nodes.select(F.col("node").alias(n), F.col("vector").alias(f"v{n}"))
    least = min(counts.values(), default=1)
    likely = pairs.where(F.col("n") >= least).join(side("a"), "a").join(side("b"), "b")
    for width, count in counts.items():
        likely = likely.where((F.size("va") != width) | (F.col("n") >= count))
    links = written(likely.select("a", "b", "va", "vb").mapInArrow(verify, "a long, b long"), "links")

    ends = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other")
    sizes = nodes.select(F.col("node").alias("other"), "n_copies")
    linked = ends.join(sizes, "other").groupBy("node").agg(F.sum("n_copies").alias("n_near"))
    named = links.join(nodes.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b"
    )
    joined = components(named.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).withColumnRenamed("node", "rep")
    classes = nodes.select("name", "node", "rep", "n_copies").join(linked, "node", "left").join(joined, "rep", "left")
    out = rows.select("vec_id", "name").join(classes, "name", "left")
    component = F.coalesce("component", "rep", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("n_copies") - 1 + F.coalesce("n_near", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )
