"""Sets that share a signature: who meets whom, and which of them link. Used by joins on sets.

Signatures travel packed by hash bucket. Nodes (named sets) that share one form lists. Most lists
come from passages that unrelated sets share, so a list's members are compared in blocks by parity
bitmaps (a bit for each hash cell, whether the set holds an odd number of features there): the number
of differing bits is a lower bound of the symmetric difference, so what it rules out is no link. In a
first pass each member keeps its best partner of each list; these pairs are verified on the full
sets and joined into components. Only lists that still reach over several components are compared
again, and pairs between components that the bitmaps allow are verified. So a group of copies is
joined by a few pairs a member, and no list is ever written out as all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import give_back, mixed, partitions, released, written
from tidegate.llm.components import components

BLOCK = 4096  # members of a list that one task compares with as many others
ROWS = 128  # of those, how many at a time
FEW = 64  # members of a list that is compared together with others
GAPS = 1 << 22  # bytes of bitmaps that are compared at once
PACKED = "bucket long, nodes binary, counts binary, keys binary"
DESCRIBED = "node long, size long, data binary"
_U = np.uint64


def difference(a, b, percent: int):
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


def packed(nodes: np.ndarray, owner: np.ndarray, sig: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket: its nodes, how many signatures each has there, and those (their upper halves)."""
    if not len(sig):
        return
    bucket = (sig % _U(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    if (owner[1:] < owner[:-1]).any():
        order = np.argsort(owner.astype(np.uint16 if len(nodes) <= 1 << 16 else np.int64), kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
    else:
        order = np.argsort(bucket, kind="stable")
    owner, sig, bucket = owner[order], sig[order] >> _U(32), bucket[order]
    turn = np.concatenate(([True], bucket[1:] != bucket[:-1]))
    first = np.flatnonzero(turn)  # of a bucket
    own = np.flatnonzero(turn | np.concatenate(([True], owner[1:] != owner[:-1])))  # of a node in it
    n = np.diff(np.concatenate((own, [len(sig)])))
    at = np.searchsorted(own, first)

    def column(values: np.ndarray, begins: np.ndarray) -> pa.Array:
        offsets = (np.concatenate((begins, [len(values)])) * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(values)])

    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[first].astype(np.int64)), column(nodes[owner[own]], at), column(n.astype(np.uint32), at), column(sig.astype(np.uint32), first)],
        ["bucket", "nodes", "counts", "keys"],
    )


def name_signatures(nodes: np.ndarray) -> np.ndarray:
    """A signature for each node that no other has; packed more than once, it tells ``lists_of`` that the node comes repeatedly."""
    return mixed(nodes.view(np.uint64) + _U(1))


def lists_of(packed: DataFrame, repeated: bool = False) -> DataFrame:
    """``list, node`` for signatures that at least two nodes share; equal lists of a bucket count once.

    ``repeated``: nodes whose name signature comes more than once are in a list null, too.
    """

    def meet(group: pa.Table) -> pa.Table:
        def all_of(name, kind):
            return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)

        node = np.repeat(all_of("nodes", np.int64), all_of("counts", np.uint32))
        key = all_of("keys", np.uint32)
        # most signatures stand alone: a cheap sort of the keys finds the others
        place = np.sort((key.astype(np.uint64) << _U(32)) | np.arange(len(key), dtype=np.uint64))
        same = (place[1:] >> _U(32)) == (place[:-1] >> _U(32))
        shared = np.zeros(len(key), bool)
        shared[1:] |= same
        shared[:-1] |= same
        place = (place[shared] & _U(0xFFFFFFFF)).astype(np.int64)
        key, node = key[place], node[place]
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        again = np.unique(node[~fresh & (key == name_signatures(node) >> _U(32))]) if repeated else node[:0]
        key, node = key[fresh], node[fresh]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[first, len(key)])
        name = np.add.reduceat(mixed(node.view(np.uint64)), first) if len(first) else np.zeros(0, np.uint64)
        _, once = np.unique(name, return_index=True)
        chosen = np.zeros(len(first), bool)
        chosen[once] = True
        chosen &= size > 1
        rows = np.repeat(chosen, size)
        found = pa.table({
            "list": pa.array(np.concatenate((np.repeat(name, size)[rows].view(np.int64), again)), mask=np.arange(rows.sum() + len(again)) >= rows.sum()),
            "node": np.concatenate((node[rows], again)),
        })
        del node, key, place, order
        give_back()
        return found

    return packed.groupBy("bucket").applyInArrow(meet, "list long, node long").distinct()


def parity(of: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """A bitmap for each set, of as many bits as the next power of two of its size (64 at least)."""
    bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    at = base[of] + (hashes & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(bool), bitorder="little").tobytes()
    return [odd[b // 8 : (b + n) // 8] for b, n in zip(base, bits)]


def common_features(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
    """Sizes of the intersections of pairs of sets, each the sorted 64-bit hashes of its features."""

    def common(x: bytes, y: bytes) -> int:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())

    return np.fromiter(map(common, xs, ys), np.int64, len(xs))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, common: Callable[[list[bytes], list[bytes]], np.ndarray]) -> DataFrame:
    """The pairs ``a, b`` of nodes that link, by their full sets."""

    def compare(batches):
        for batch in batches:
            shared = common(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            both = np.asarray(batch.column(4)) + np.asarray(batch.column(5)) - shared
            yield batch.select([0, 1]).filter(pa.array(100 * shared >= percent * both))

    left = sets.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("data").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("data").alias("xb"))
    near = pairs.join(left, "a").join(right, "b").where(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    )
    return near.select("a", "b", "xa", "xb", "na", "nb").mapInArrow(released(compare), "a long, b long")


def _distances(size: np.ndarray, data: list[bytes]):
    """Differing bits between members ``i`` and ``j >= i`` of a run sorted by size, as a function of blocks."""
    width = np.array([len(d) // 8 for d in data])
    edges = np.r_[0, np.flatnonzero(np.diff(width)) + 1, len(width)]
    full = [np.frombuffer(b"".join(data[s:e]), np.uint64).reshape(e - s, -1) for s, e in zip(edges[:-1], edges[1:])]

    def gaps(c: int, rows: np.ndarray, d: int, cols: slice) -> np.ndarray:
        other = full[d][cols]
        while other.shape[1] > full[c].shape[1]:  # bits of the larger bitmap that fall together in the smaller one
            half = other.shape[1] // 2
            other = other[:, :half] ^ other[:, half:]
        out = np.zeros((len(rows), len(other)), np.int64)
        for w in range(other.shape[1]):
            out += np.bitwise_count(full[c][rows, w][:, None] ^ other[None, :, w])
        return out

    return edges, gaps


def _close(members: DataFrame, percent: int, best: bool) -> DataFrame:
    """``list, a, b``: members of a list in different components (``label``) whose bitmaps (``data``) allow a link.

    ``best``: of those only the nearest partner of each member. A list of more than BLOCK members is dealt
    out over several tasks, each with two blocks of it.
    """
    sizes = members.groupBy("list").agg(F.count("*").alias("members")).where(F.col("members") > BLOCK)
    sized = members.join(sizes, "list", "left")
    blocks = F.coalesce(F.ceil(F.col("members") / BLOCK).cast("int"), F.lit(1))
    placed = sized.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "list", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "block", "node", "label", "size", "data",
    )

    def pairs_of(run: dict, key: tuple) -> pa.RecordBatch | None:
        order = np.lexsort((run["node"], run["size"]))
        node, label, size, block = (run[c][order] for c in ("node", "label", "size", "block"))
        edges, gaps = _distances(size, [run["data"][i] for i in order])
        reach = np.searchsorted(size, 100 * size // percent, side="right")
        left, right, gap = [], [], []
        for c in range(len(edges) - 1):
            for s in range(edges[c], edges[c + 1], ROWS):
                i = np.arange(s, min(s + ROWS, edges[c + 1]))
                for d in range(c, len(edges) - 1):
                    end = min(int(reach[i].max()), edges[d + 1])
                    begin = max(int(i[0]) + 1, edges[d])
                    if begin >= end:
                        continue
                    j = np.arange(begin, end)
                    fine = (j[None] > i[:, None]) & (j[None] < reach[i][:, None]) & (label[j][None] != label[i][:, None])
                    if key[1] != key[2]:
                        fine &= block[j][None] != block[i][:, None]
                    if not fine.any():
                        continue
                    g = gaps(c, i - edges[c], d, slice(begin - edges[d], end - edges[d]))
                    fine &= g <= difference(size[i][:, None], size[j][None], percent)
                    u, v = np.nonzero(fine)
                    left.append(i[u])
                    right.append(j[v])
                    gap.append(g[u, v])
        if not left or not sum(map(len, left)):
            return None
        left, right, gap = map(np.concatenate, (left, right, gap))
        if best:
            ends, others, both = np.r_[left, right], np.r_[right, left], np.r_[gap, gap]
            order = np.lexsort((node[others], both, ends))
            first = order[np.r_[True, np.diff(ends[order]) != 0]]
            left, right = ends[first], others[first]
        a, b = node[left], node[right]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), key[0])), pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["list", "a", "b"]
        )

    def of_few(rows: dict, data: list[bytes], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists of few members, all at once: (which of the runs these are, rows of the pairs that may link)."""
        few = np.flatnonzero(np.diff(cuts) <= FEW)
        few = few[(few > 0) & (few < len(cuts) - 2)]  # the first and the last run may go on in another batch
        n = np.diff(cuts)[few]
        member = np.repeat(cuts[few] - np.cumsum(n) + n, n) + np.arange(n.sum())
        later = np.repeat(cuts[few] + n, n) - member - 1  # members after this one
        left = np.repeat(member, later)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)
        size, label, block = rows["size"], rows["label"], rows["block"]
        fine = 100 * np.minimum(size[left], size[right]) >= percent * np.maximum(size[left], size[right])
        fine &= (label[left] != label[right]) & ((rows["x"][left] == rows["y"][left]) | (block[left] != block[right]))
        left, right = left[fine], right[fine]
        width = np.fromiter(map(len, data), np.int64, len(data)) // 8
        swap = width[left] > width[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        gap = np.zeros(len(left), np.int64)
        for narrow in np.unique(width[left]):
            for wide in np.unique(width[right][width[left] == narrow]):
                pairs = np.flatnonzero((width[left] == narrow) & (width[right] == wide))
                step = max(1, GAPS // (8 * int(wide)))
                for at in (pairs[k : k + step] for k in range(0, len(pairs), step)):
                    a, b = (np.frombuffer(b"".join([data[i] for i in ends[at].tolist()]), np.uint64).reshape(len(at), -1) for ends in (left, right))
                    while b.shape[1] > narrow:  # bits that fall together in the smaller bitmap
                        b = b[:, : b.shape[1] // 2] ^ b[:, b.shape[1] // 2 :]
                    gap[at] = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
        near = gap <= difference(size[left], size[right], percent)
        left, right, gap = left[near], right[near], gap[near]
        if best and len(left):
            ends, others, both = np.r_[left, right], np.r_[right, left], np.r_[gap, gap]
            order = np.lexsort((rows["node"][others], both, ends))
            first = order[np.r_[True, np.diff(ends[order]) != 0]]
            left, right = ends[first], others[first]
        return few, left, right

    def scan(batches):
        kept, key = [], None
        for batch in batches:
            rows = {c: np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("list", "x", "y", "block", "node", "label", "size")}
            data = batch.column(batch.schema.get_field_index("data")).to_pylist()
            keys = np.stack([rows["list"], rows["x"], rows["y"]], 1)
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)]
            done, left, right = of_few(rows, data, cuts)
            if len(left):
                a, b = rows["node"][left], rows["node"][right]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["list"][left]), pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["list", "a", "b"]
                )
            rows = {c: v for c, v in rows.items() if c not in ("list", "x", "y")}
            for run in np.setdiff1d(np.arange(len(cuts) - 1), done):
                s, e = cuts[run : run + 2]
                if s == e:
                    continue
                now = tuple(int(k) for k in keys[s])
                if key is not None and now != key and (found := pairs_of(_run(kept), key)) is not None:
                    yield found
                if now != key:
                    kept, key = [], now
                kept.append({c: v[s:e] for c, v in rows.items()} | {"data": data[s:e]})
        if kept and (found := pairs_of(_run(kept), key)) is not None:
            yield found

    dealt = tiles.repartition(partitions(members.sparkSession), "list", "x", "y").sortWithinPartitions("list", "x", "y")
    return dealt.mapInArrow(released(scan), "list long, a long, b long")


def _run(kept: list[dict]) -> dict:
    whole = {c: np.concatenate([k[c] for k in kept]) for c in kept[0] if c != "data"}
    return whole | {"data": [d for k in kept for d in k["data"]]}


def described(nodes: np.ndarray, of: np.ndarray, hashes: np.ndarray, whole: bool) -> pa.RecordBatch:
    """``node, size, data`` of sets with at least one feature: the sorted features or their parity bitmap."""
    sizes = np.bincount(of, minlength=len(nodes))
    ends, some = np.cumsum(sizes), np.flatnonzero(sizes)
    if whole:
        data = [hashes[ends[i] - sizes[i] : ends[i]].tobytes() for i in some]
    else:
        bits = parity(of, hashes, sizes)
        data = [bits[i] for i in some]
    columns = [pa.array(nodes[some]), pa.array(sizes[some]), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["node", "size", "data"])


def once(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """One description for each wanted node."""
    single = found.groupBy("node").agg(*[F.first(c).alias(c) for c in found.columns if c != "node"])
    return single.join(wanted.select("node"), "node", "left_semi")


def linked(
    lists: DataFrame, sets_of: Callable[[DataFrame, bool], DataFrame], percent: int, common: Callable[[list[bytes], list[bytes]], np.ndarray] = common_features,
) -> DataFrame:
    """Links ``a, b`` that join all nodes that are linked, directly or over others, as the lists tell; some lead to a component's smallest node instead.

    ``sets_of(wanted, whole)`` describes the wanted nodes: their full sets or their bitmaps. If what it gives with the
    bitmaps has a column ``full``, that holds the full sets, of which ``common`` counts the shared features.
    """
    met = written(lists.select("node").distinct(), "met")
    described_once = written(sets_of(met, False), "described")
    members = lists.join(described_once.select("node", "size", "data"), "node")

    # first every member's best partner in each list
    first = written(_close(members.withColumn("label", F.col("node")), percent, True), "best")
    pairs = written(first.select("a", "b").distinct(), "pairs")
    ends = written(first.select(F.col("a").alias("node")).union(first.select("b")).distinct(), "ends")
    if "full" in described_once.columns:
        sets = described_once.select("node", "size", F.col("full").alias("data"))
    else:
        sets = written(sets_of(ends, True), "full-sets")
    labels = written(components(written(_verified(pairs, sets, percent, common), "near")), "labels")

    # then what is left of lists that reach over several components; a list without a pair has no link
    live = members.join(first.select("list").distinct(), "list", "left_semi").join(ends, "node", "left_semi")
    labelled = live.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    open_lists = labelled.groupBy("list").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
    rest = labelled.join(open_lists.select("list"), "list", "left_semi")
    more = _close(rest, percent, False).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    stars = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return written(stars.unionByName(_verified(written(more, "close"), sets, percent, common)), "links")
