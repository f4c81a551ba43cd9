"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

Texts are described by the runs of one to three words that they hold, hashed into BUCKETS. Two arrays of counts,
over all documents and over all target texts, give each bucket a gain, the logarithm of how much likelier it is in
the target; a document's weight is the sum of the gains of its runs, looked up in that array. Gumbel noise
that follows from the document's id turns the highest scores into a draw without replacement.

The order comes from a least-significant-digit radix sort: one stable counting-sort pass for each digit of the
composite key (score, then id). A pass counts digits in blocks of positions, adds the counts up in the order
(digit, block) to offsets, and gives every row its next position: the offset plus the row's place among the rows of its
block that have its digit. No pass needs a global sort, a window over more than a block, or the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import written

BUCKETS, LONGEST = 10000, 3
SEED, PERCENT, LEAST_WORDS = "42", 5, 20
DIGIT_BITS = 11
BLOCK_BITS = 18  # positions that one block of a counting pass spans
PART = 1 << 20  # bytes of a text that are cut into words at once

# A-Z are folded; digits, a-z and everything above ASCII are word characters, all others are blanks.
_CLEAN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def feature_buckets(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end with one of them) for stretches of a text, which cover it."""
    clean, at, before = text.translate(_CLEAN), 0, []
    while at < len(clean):
        end = clean.find(b" ", at + PART)
        end = len(clean) if end < 0 else end
        words = clean[at:end].split()
        at = end
        if not words:
            continue
        row = before + words
        spaced = [b" " + w for w in row]
        sums = list(map(crc32, row))
        runs = sums[len(before) :]
        for k in range(1, LONGEST):
            sums = list(map(crc32, spaced[k:], sums))  # runs of k + 1 words, the first ends at row[k]
            runs += sums[max(0, len(before) - k) :]
        yield len(words), np.array(runs, np.uint32) % BUCKETS
        before = row[-(LONGEST - 1) :]


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    for cell in batch.column(batch.schema.get_field_index(name)):
        yield cell.as_py() or b""


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``bucket, n``: how often the runs of all texts fall into each bucket; a task sends one array."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for whole in _texts(batch, "text"):
                for _, found in feature_buckets(whole):
                    total += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    single = texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
    return single.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of each bucket, in thousandths, rounded down. The driver holds two numbers for each of the BUCKETS."""
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for counts, table in ((s, docs), (t, target)):
        for bucket, n in bucket_counts(table).collect():
            counts[bucket] = n
    over, under = s.sum() + BUCKETS, t.sum() + BUCKETS
    return np.array([math.floor(1000 * math.log((b + 1) * over / ((a + 1) * under))) for a, b in zip(s, t)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row; a null text has no words and weight 0."""
    kept = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def weigh(batches):
        for batch in batches:
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for i, whole in enumerate(_texts(batch, "text")):
                for words, found in feature_buckets(whole):
                    rows[i] += (words, len(found), gain[found].sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, rows.T.copy())], ["doc_id", "n_words", "n_features", "weight"]
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """Noise in thousandths from the first 32 bits of a hash of the seed and the id; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((bits + 0.5) / F.lit(4294967296.0)))).cast("long")


def _counting_pass(rows: DataFrame, digit: Column, block_bits: int) -> DataFrame:
    """``rows`` with the positions ``pos`` they have after a stable counting sort by ``digit``."""
    placed = rows.select("*", F.shiftright("pos", block_bits).alias("block"), digit.alias("digit"))
    counted = written(placed.groupBy("block", "digit").agg(F.count("*").alias("n")), "digits")
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # one row a digit
    totals = counted.groupBy("digit").agg(F.sum("n").alias("n")).select(
        "digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("start")
    )
    offsets = counted.select("block", "digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip")).join(totals, "digit")
    offsets = offsets.select("block", "digit", (F.col("start") + F.col("skip")).alias("offset"))
    inside = Window.partitionBy("block", "digit").orderBy("pos")
    ranked = placed.withColumn("place", F.row_number().over(inside) - 1).join(offsets, ["block", "digit"])
    return ranked.withColumn("pos", F.col("offset") + F.col("place")).select(rows.columns)


def radix_ranks(rows: DataFrame, keys: list[tuple[str, bool]], digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` with ``pos``, their place (from 0) in the order of the long columns ``keys`` (name, descending).

    The first key leads. Nulls come last. Rows alike in all keys follow each other in some order. Digits are taken of the
    distance from a key's first value, so only digits that occur cost a pass; each pass is written.
    """
    asked = [f(name).alias(f"{name}_{f.__name__}") for name, _ in keys for f in (F.min, F.max)]
    asked += [F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name, _ in keys]
    current = written(rows.withColumn("pos", F.monotonically_increasing_id()), "unsorted")
    seen = current.agg(*asked).first()
    digits: list[Column] = []
    for name, descending in reversed(keys):
        low, high = seen[f"{name}_min"], seen[f"{name}_max"]
        if low is not None:
            if high - low < 1 << 63:
                apart = F.lit(high) - F.col(name) if descending else F.col(name) - F.lit(low)
                bits = (high - low).bit_length()
            else:  # the distance needs the 64th bit
                apart = F.col(name).bitwiseXOR(F.lit((1 << 63) - 1 if descending else -(1 << 63)))
                bits = 64
            for shift in range(0, bits, digit_bits):
                digit = F.shiftrightunsigned(apart, shift).bitwiseAND(F.lit((1 << digit_bits) - 1))
                digits.append(F.coalesce(digit, F.lit(0)).cast("int"))
        if seen[f"{name}_nulls"]:
            digits.append(F.col(name).isNull().cast("int"))
    for digit in digits or [F.lit(0)]:  # one pass at least, which makes the positions whole
        current = written(_counting_pass(current, digit, block_bits), "pass")
    return current


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, **sort: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row of ``docs``.

    Of the rows with at least ``least_words`` words, the ``percent`` with the highest scores are drawn and have a rank, 1 for the
    highest; of equal scores the smaller id goes first, a null id last. Rows alike in score and id share their ranks out in
    some order. No documents give no rows; without target texts every bucket still has a gain. Columns other
    than ``doc_id`` and ``text`` play no part.
    """
    scored = weighted(docs, gains(docs, target)).withColumn("score", F.col("weight") + gumbel())
    facts = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = facts.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranks = radix_ranks(able.select("row", "score", "doc_id"), [("score", True), ("doc_id", False)], **sort)
    taken = ranks.where(F.col("pos") < drawn).select("row", (F.col("pos") + 1).alias("rank"))
    return facts.join(taken, "row", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")
