"""Fuzzy line dedup: one line of each group of near-equal lines stays in the corpus.

Lines are compared in a normal form (A-Z lower-cased, runs of blanks one space, trimmed); lines that are then
empty stay. Lines equal in normal form are one node, however short. A node's set is that of its byte shingles;
lines of one shingle can only be equal. A signature is a one-permutation MinHash of BINS bins, an empty bin borrowing
from a bin that a fixed sequence names, and each of BANDS bands is a fixed choice of ROWS bins. Lines that share a
band form lists, which are compared and verified as documents are in ``signatures``: pairs have an exact
Jaccard similarity of at least PERCENT. Components come from the distributed union-find, and the first line of
each component, by document and place, is the one that stays.

Measured on pairs of edited lines of 9 to 200 bytes with a similarity of 0.75 to 0.80, 98 % share a band; of pairs
with a similarity of 0.2 to 0.3 it is 0.07 %, and below 0.1 none of 20,000, so the lines that meet hardly
grow faster than the lines.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import bitmap as bm
from tidegate.llm import signatures as sg
from tidegate.llm.common import keeps_columns, mixed, partitions, powers, released, text_runs, written
from tidegate.llm.components import components

SHINGLE, PERCENT = 7, 75
BANDS, ROWS = 40, 8
BINS = 128
CHARS_A_BUCKET = 8_000_000
RUN = 1 << 16  # bytes of text that are cut into lines at once: few enough for a core's cache
STEPS = 1 << 10  # of an empty bin's sequence
FEW = 16  # full bins: a set with no more finds what its empty bins borrow in a table
MEASURED = 1 << 18  # bytes of lines that are measured at once
_U = np.uint64
_BYTE = mixed(np.arange(256, dtype=np.uint64) + _U(9000))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_FOLD = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\v\f\r", b"abcdefghijklmnopqrstuvwxyz    "))
_BLANKS = re.compile(b"  +")


def normal_lines(texts: list[bytes], least: int = 1):
    """(bytes that hold all lines in normal form, start and length of each, text, place in the text).

    Every line is counted for its place; only those of ``least`` bytes or more are given back.
    """
    joined = b"\n".join([*texts, b""]).translate(_FOLD)
    data = np.frombuffer(joined, np.uint8)
    blank = data == 32
    if (blank[1:] & blank[:-1]).any():
        joined = _BLANKS.sub(b" ", joined)
        data = np.frombuffer(joined, np.uint8)
    cut = joined.split(b"\n")[:-1]
    length = np.fromiter(map(len, cut), np.int64, len(cut))
    start = np.cumsum(length + 1) - length - 1
    # a line now begins and ends with one blank at most; what stands there for an empty one is a line feed
    first = data[start] == 32
    start += first
    length -= first
    length -= (length > 0) & (data[start + length - 1] == 32)
    n = np.fromiter((text.count(b"\n") + 1 for text in texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    some = np.flatnonzero(length >= least)
    return data, start[some], length[some], of[some], place[some]


def _totals(data) -> np.ndarray:
    """Position hashes of what comes before each byte, and of all."""
    total = np.zeros(len(data) + 1, np.uint64)
    values = _BYTE[data]
    values *= powers(_BASE, len(data))
    np.cumsum(values, out=total[1:])
    return total


def _hashes(total, starts, lengths):
    """Position hash of every byte run, as a function of (start, length)."""
    return mixed((total[starts + lengths] - total[starts]) * powers(_INVERSE, len(total))[starts])


def names(total, starts, lengths) -> np.ndarray:
    return mixed(_hashes(total, starts, lengths) + lengths.astype(np.uint64)).view(np.int64)


def line_shingles(data, starts, lengths, size: int = SHINGLE, total=None):
    """(hash of each shingle, line it is of), repeats included; ``total`` are the ``_totals`` of ``data``."""
    total = _totals(data) if total is None else total
    n = np.maximum(lengths - size + 1, 1)
    of = np.repeat(np.arange(len(starts)), n)
    at = np.repeat(starts - np.cumsum(n) + n, n)
    at += np.arange(len(of))
    if not len(of) or lengths.min() < size:
        return _hashes(total, at, np.minimum(lengths, size)[of]), of
    # all runs have one length: those at neighbouring places are taken together
    values = total[size:] - total[:-size]
    values *= powers(_INVERSE, len(values))
    return mixed(values)[at], of


@lru_cache(maxsize=4)
def _sequences(bins: int) -> np.ndarray:
    """A row a step: the bin that each bin looks at then."""
    return np.stack([(mixed(np.arange(bins, dtype=np.uint64) + _U(step << 20)) % _U(bins)).astype(np.int64) for step in range(STEPS)])


@lru_cache(maxsize=4)
def _visits(bins: int) -> np.ndarray:
    """Of each bin and each empty bin: ``step * bins + bin`` of the first step at which the latter looks at the former; STEPS * bins if it never does."""
    first = np.full((bins, bins), STEPS * bins, np.int32)
    for step in range(STEPS - 1, 0, -1):
        looked = _sequences(bins)[step]
        first[looked, np.arange(bins)] = step * bins + looked
    return first


def min_hashes(hashes, of, n: int, bins: int = BINS) -> np.ndarray:
    """One-permutation MinHash of ``n`` sets, a row each, in a power of two of ``bins``; an empty bin takes the value of the first full bin of its sequence."""
    none = np.iinfo(np.uint64).max
    low = np.full(n * bins, none, np.uint64)
    at = (hashes & _U(bins - 1)).view(np.int64)
    at += of * bins
    np.minimum.at(low, at, hashes >> _U(bins.bit_length() - 1))
    filled = low.copy().reshape(n, bins)
    empty = (low == none).reshape(n, bins)
    n_full = bins - np.count_nonzero(empty, axis=1)

    few = np.flatnonzero((n_full > 0) & (n_full <= FEW))
    for some in (few[k : k + 512] for k in range(0, len(few), 512)):
        row, full = np.nonzero(~empty[some])
        best = np.minimum.reduceat(_visits(bins)[full], np.searchsorted(row, np.arange(len(some))), axis=0)
        row, col = np.nonzero(empty[some] & (best < STEPS * bins))
        step, other = np.divmod(best[row, col].astype(np.int64), bins)
        filled[some[row], col] = mixed(low[some[row] * bins + other] + step.astype(np.uint64))

    filled = filled.ravel()
    places = np.flatnonzero(empty & (n_full > FEW)[:, None])
    left, step, others = places, 1, _sequences(bins)
    while len(left) > 512 and step < STEPS:
        col = left & (bins - 1)
        found = low[others[step][col] + (left - col)]
        none_yet = found == none
        filled[left] = found + _U(step)
        left, step = left[none_yet], step + 1
    filled[left] = none
    while len(left) and step < STEPS:
        # many steps at once, as few bins are left
        steps = others[step : step + max(1, (1 << 9) // len(left))]
        col = left & (bins - 1)
        found = low[steps[:, col] + (left - col)]
        good = found != none
        taken, done = good.argmax(0), np.flatnonzero(good.any(0))
        filled[left[done]] = found[taken[done], done] + (step + taken[done]).astype(np.uint64)
        left, step = left[~good.any(0)], step + len(steps)
    borrowed = places[filled[places] != none]
    filled[borrowed] = mixed(filled[borrowed])
    return filled.reshape(n, bins)


def _source(docs: DataFrame, id_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text")
    ).where("text is not null")


@lru_cache(maxsize=4)
def band_bins(bands: int = BANDS, rows: int = ROWS, bins: int = BINS) -> np.ndarray:
    """The bins of each band, ``rows`` different ones, alike on every machine."""
    order = np.argsort(mixed(np.arange(bands * bins, dtype=np.uint64) + _U(1 << 32)).reshape(bands, bins), 1, kind="stable")
    return order[:, :rows]


def band_hashes(low: np.ndarray) -> np.ndarray:
    """A row a set of MinHashes: the hash of the bins of each band, equal where these bins are."""
    chosen, bins = band_bins(), low.shape[1]
    parts = np.ascontiguousarray(low.T)
    parts *= (mixed(np.arange(bins, dtype=np.uint64) + _U(1 << 33)) | _U(1))[:, None]
    band = np.repeat(mixed(np.arange(BANDS, dtype=np.uint64))[:, None], len(low), 1)
    for r in range(ROWS):
        band += parts[chosen[:, r]]
    return mixed(np.ascontiguousarray(band.T))


def _banded(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed signatures: the bands of each line that is longer than a shingle, and one for each line's name, twice if a batch has the line twice."""

    def pack(batches):
        for batch in batches:
            found, every = [], []
            for _, _, texts in text_runs(batch.column(0), RUN):
                data, start, length, _, _ = normal_lines(texts)
                if not len(start):
                    continue
                total = _totals(data)
                node = names(total, start, length)
                every.append(node)
                long = np.flatnonzero(length > SHINGLE)
                _, once = np.unique(node[long], return_index=True)
                at = long[np.sort(once)]
                if len(at):
                    low = min_hashes(*line_shingles(data, start[at], length[at], total=total), len(at))
                    found.append((node[at], band_hashes(low)))
            if every:
                node, copies = np.unique(np.concatenate(every), return_counts=True)
                copied = np.flatnonzero(copies > 1)
                owner, sig = [np.arange(len(node)), copied], [sg.name_signatures(node), sg.name_signatures(node[copied])]
                if found:
                    banded, band = map(np.concatenate, zip(*found))
                    banded, once = np.unique(banded, return_index=True)
                    owner.append(np.repeat(np.searchsorted(node, banded), BANDS))
                    sig.append(band[once].ravel())
                yield from sg.packed(node, np.concatenate(owner), np.concatenate(sig), buckets)

    texts_only = docs.select(F.col("text").cast("binary").alias("text")).where("text is not null")
    return texts_only.mapInArrow(released(pack), sg.PACKED)


def _starts(lines_of: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(lines_of), np.uint8)
    length = np.fromiter(map(len, lines_of), np.int64, len(lines_of))
    return data, np.cumsum(length) - length, length


def _distinct(data, start, length):
    """(line, hash) of each different shingle of lines, sorted by both; of the hash the bits that the line's number leaves free."""
    hashes, of = line_shingles(data, start, length)
    bits = _U(64 - max(1, len(start) - 1).bit_length())
    both = np.sort((of.astype(np.uint64) << bits) | (hashes & ((_U(1) << bits) - _U(1))))
    both = both[np.concatenate(([True], both[1:] != both[:-1]))[: len(both)]]
    return (both >> bits).astype(np.int64), both & ((_U(1) << bits) - _U(1))


def _exact(lines_of: list[bytes]) -> np.ndarray:
    """The different shingles of up to 256 lines, sorted: the line's number above the seven bytes as they are."""
    data, start, length = _starts([*lines_of, b"\0"])
    n = length[:-1] - SHINGLE + 1
    of = np.repeat(np.arange(len(n)), n)
    at = np.repeat(start[:-1] - np.cumsum(n) + n, n)
    at += np.arange(len(of))
    # eight bytes from every place on, of which the first seven count
    values = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))[at]
    values &= _U((1 << 56) - 1)
    values |= of.astype(np.uint64) << _U(56)
    values.sort()
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def common_shingles(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
    """Number of shingles that both lines of each pair have; lines are longer than a shingle."""
    shared = [np.zeros(0, np.int64)]
    size = np.cumsum([len(x) + len(y) for x, y in zip(xs, ys)])
    begin = 0
    while begin < len(xs):
        done = size[begin - 1] if begin else 0
        end = min(begin + 256, max(begin + 1, int(np.searchsorted(size, done + MEASURED, side="right"))))
        both = np.sort(np.concatenate((_exact(xs[begin:end]), _exact(ys[begin:end]))), kind="stable")
        twice = both[1:][both[1:] == both[:-1]]
        shared.append(np.bincount((twice >> _U(56)).astype(np.int64), minlength=end - begin))
        begin = end
    return np.concatenate(shared)


def _measured(lines_of: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """(number of different shingles, parity bitmap) of each line."""
    size, bits, begin = [np.zeros(0, np.int64)], [], 0
    ends = np.cumsum(np.fromiter(map(len, lines_of), np.int64, len(lines_of)))
    while begin < len(lines_of):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + MEASURED, side="right")))
        of, hashes = _distinct(*_starts(lines_of[begin:end]))
        size.append(np.bincount(of, minlength=end - begin))
        bits += sg.parity(of, hashes, size[-1])
        begin = end
    return np.concatenate(size), bits


def _wanted_lines(docs: DataFrame, id_column: str, met: DataFrame, copied: DataFrame) -> DataFrame:
    """``doc_id, row, place, node`` for at least every line that is one of these nodes; ``row`` is a hash of the text, ``node`` of the line.

    With the first line of a batch that is one of ``met`` go ``size, data, full``: the number of different
    shingles, their parity bitmap, the line in normal form. Elsewhere these are null.
    """
    held, held_copied = bm.bitmap(met, "node"), bm.bitmap(copied, "node")

    def measure(batches):
        for batch in batches:
            found, lines_of = [], []
            for begin, _, texts in text_runs(batch.column(2), RUN):
                data, start, length, of, place = normal_lines(texts)
                node = names(_totals(data), start, length)
                near = bm.holds(held, node) & (length > SHINGLE)
                at = np.flatnonzero(near | bm.holds(held_copied, node))
                found.append((of[at] + begin, place[at], node[at], near[at]))
                first = np.zeros(len(at), bool)
                first[np.unique(node[at], return_index=True)[1]] = True
                at, whole = at[first & near[at]], data.tobytes()
                lines_of += zip(node[at].tolist(), (whole[s : s + n] for s, n in zip(start[at].tolist(), length[at].tolist())))
            if not found:
                continue
            of, place, node, near = map(np.concatenate, zip(*found))
            full_of, described = dict(lines_of), np.flatnonzero(near)
            described = described[np.unique(node[described], return_index=True)[1]]
            full = [full_of[n] for n in node[described].tolist()]
            size, bits = _measured(full)
            some = np.full(len(node), -1)
            some[described] = np.arange(len(described))
            some, at = pa.array(some, mask=some < 0), pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(place), pa.array(node), pa.array(size).take(some),
                 pa.array(bits, pa.binary()).take(some), pa.array(full, pa.binary()).take(some)],
                ["doc_id", "row", "place", "node", "size", "data", "full"],
            )

    return _source(docs, id_column).mapInArrow(released(measure), f"doc_id long, row long, place long, {sg.DESCRIBED}, full binary")


def duplicate_lines(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, row, place``: the lines that go. Of each component the first line by document id, then text hash, then place, stays."""
    spark = docs.sparkSession
    position = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row", "place")
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(spark), -(-chars // CHARS_A_BUCKET))
    lists = written(sg.lists_of(_banded(docs, buckets), repeated=True), "lists")
    copied = lists.where("list is null").select("node")
    lines = []

    def sets_of(met: DataFrame, _: bool) -> DataFrame:
        lines.append(written(_wanted_lines(docs, id_column, met, copied), "lines"))
        return sg.once(lines[0].where("size is not null").select("node", "size", "data", "full"), met)

    joined = components(sg.linked(lists.where("list is not null"), sets_of, PERCENT, common_shingles))
    # the lines of nodes that have copies or partners; all others stay
    alone = copied.join(joined, "node", "left_anti").withColumn("component", F.col("node"))
    many = lines[0].select("doc_id", "row", "place", "node").join(joined.unionByName(alone), "node")
    several = written(many.select("component", "doc_id", "row", "place"), "several")
    first = several.groupBy("component").agg(F.min(position).alias("stays"))
    return several.join(first, "component").where(position != F.col("stays")).select("doc_id", "row", "place")


@keeps_columns("_row", "_maybe", "_d", "_r")
def deduplicated(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines`` (before) and ``removed`` (places, ascending).

    Lines end at line feeds. Null texts stay null with 0 lines; an empty text is one empty line. Documents
    stay even if no line of them does (their text is then empty). Rows equal in id and text are one
    document. ``n_lines`` and ``removed`` columns of the input are replaced.
    """
    goes = duplicate_lines(docs, id_column)
    # a document's own lines only
    gone = written(goes.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("place")).alias("removed")), "gone")
    base = docs.drop("n_lines", "removed")
    intact, likely = bm.split_off(base, gone, id_column)
    named = gone.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "removed")
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    split = F.split("text", "\n", -1)
    places = F.coalesce("removed", F.array().cast("array<bigint>"))
    left = F.array_join(F.filter(split, lambda line, i: ~F.array_contains(places, i.cast("bigint"))), "\n")
    changed = likely.join(named, bm.same_row(id_column), "left").drop("_d", "_r").withColumns({
        "text": F.when(F.col("removed").isNull(), F.col("text")).otherwise(left), "n_lines": n_lines, "removed": places,
    })
    out = intact.withColumns({"n_lines": n_lines, "removed": F.array().cast("array<bigint>")}).unionByName(changed)
    return out.withColumn("n_lines", F.coalesce("n_lines", F.lit(0)).cast("long")).select(
        *[c for c in docs.columns if c not in ("n_lines", "removed")], "n_lines", "removed"
    )
