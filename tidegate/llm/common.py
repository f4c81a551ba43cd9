"""What the operators of this folder share: tables, written intermediate results, word hashes."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.runtime import scratch_path

# A word is a run of anything but these six ASCII characters: space, tab, line feed,
# vertical tab, form feed, carriage return. ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_LIBC = ctypes.CDLL("libc.so.6") if sys.platform == "linux" else None
_shipped: set[str] = set()
BATCH_BYTES, _BATCH = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the Python tasks of a local session this package, unless the environment already does.

    On a cluster the package is installed or sent with the job, as any other.
    """
    if not spark.sparkContext.master.startswith("local["):
        return
    root = Path(__file__).resolve().parents[2]
    known = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    application = spark.sparkContext.applicationId
    if root in known or application in _shipped:
        return
    archive = Path(tempfile.mkdtemp()) / "tidegate.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "tidegate").rglob("*.py")):
            out.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES, unless the session asks for less: texts are long, and every task holds some batches."""
    size = spark.conf.get(_BATCH).rstrip("bB")
    if not size.isdigit() or not 0 < int(size) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lost executors don't matter."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return free memory to the system: Python workers live on after a task, and the next ones share their host."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def released(work: Callable) -> Callable:
    """``work`` on the batches of a task, for ``mapInArrow``; when it is done its memory is given back."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def text_runs(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end row, texts) for runs of a binary column of about ``limit`` bytes; null is empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(sizes):
        whole = np.cumsum(sizes[begin:])
        end = begin + max(1, int(np.searchsorted(whole, limit, side="left")))
        yield begin, end, [t or b"" for t in column.slice(begin, end - begin).to_pylist()]
        begin = end


def keeps_columns(*own: str) -> Callable:
    """For functions on a table that use columns of these names themselves: the table's own ones are set aside meanwhile."""

    def wrap(work: Callable) -> Callable:
        @wraps(work)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            aside, taken = {}, {c.lower() for c in df.columns}
            for column in df.columns:
                if column.lower() in own:
                    name = f"own {column}"
                    while name.lower() in taken:
                        name = f"own {name}"
                    taken.add(name.lower())
                    aside[column] = name
            out = work(df.withColumnsRenamed(aside) if aside else df, *args, **kwargs)
            return out.withColumnsRenamed({name: column for column, name in aside.items()}) if aside else out

        return run

    return wrap


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words; null counts as an empty text."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(inner, "[^w]", "")).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- 64-bit hashes in numpy, alike on every machine -------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public splitmix64 generator, on an array of unsigned 64-bit integers."""
    x = (x + _GOLD).astype(np.uint64, copy=False)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1000))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return have[:n]


def chunks(texts: list[bytes], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes together, so that memory does not follow the batch."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word after A-Z are lower-cased, number of words in each text)."""
    joined = _FOLD[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    blank = _BLANK[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(lengths + 1)
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, stops))))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[joined] * powers(_BASE, len(joined)), dtype=np.uint64)))
    return mixed((total[ends] - total[starts]) * powers(_INVERSE, len(joined))[starts]), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``size`` words, text it is of); a shorter text is one run, without words none."""
    ends = np.cumsum(counts)
    begins = ends - counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + begins[of]
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    last, out = ends[of], np.zeros(len(of), np.uint64)
    for k in range(size):
        inside = at + k < last
        out = mixed(out + np.where(inside, padded[at + k], np.uint64(k + 1)))
    return out, of


def shingle_sets(texts: list[bytes], size: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """For runs of texts: (which, text of each distinct shingle, its hash), sorted by both."""
    for first, end in chunks(texts):
        hashes, of = shingle_hashes(*word_hashes(texts[first:end]), size)
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        new = np.ones(len(of), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        yield slice(first, end), of[new], hashes[new]
