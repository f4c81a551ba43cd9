import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from fixtures import SF, documents, prose
from pyspark.sql import functions as F

from tidegate.llm import importance_resampling as ir
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [
        crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)
    ]


def brute(docs, targets):
    """{row number: (doc_id, n_features, weight, score, rank)} of ``(doc_id, text)`` rows."""
    found = [(i, *buckets(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, b in found:
        s.update(b)
    for text in targets:
        t.update(buckets(text)[1])
    over, under = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * float(over) / ((s[b] + 1) * float(under)))) for b in range(10000)]
    rows = []
    for doc_id, words, b in found:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in b)
        rows.append([doc_id, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, row in enumerate(able[: len(able) * 5 // 100]):
        row[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


def got(spark, docs, targets, **options):
    out = ir.resampled(docs, spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id long, text string"), **options)
    return Counter(tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_whole_query_equals_brute_force(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()])
    assert Counter(tuple(r) for r in QUERIES["op12_importance_resampling"](spark, SF).collect()) == want


def test_long_texts_in_stretches(monkeypatch):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("aB9é-") for _ in range(rng.randrange(1, 9))) for _ in range(400))
    words, want = buckets(text)
    for part in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(ir, "PART", part)
        found = list(ir.feature_buckets(text.encode()))
        assert sum(n for n, _ in found) == len(words)
        assert sorted(b for _, a in found for b in a) == sorted(want)


ODD = [
    (1, None), (2, ""), (3, " .,;\n"), (4, "one"), (5, "One two"), (6, "ÀÉ été 中文 a-b_c"), (7, prose(1, 40)), (7, prose(1, 40)),
    (8, "same " * 25), (9, "same " * 25), (None, prose(2, 30)), (-5, prose(3, 30)), (10, "word " * 20000), (11, "x" * 100000),
]


def test_odd_rows(spark):
    more = [(100 + i, prose(i, 25)) for i in range(60)]
    want = brute(ODD + more, ["the river", None, "", "Same same"])
    docs = documents(spark, ODD + more).withColumns({c: F.lit("x") for c in ("row", "pos", "rank", "score", "bucket", "n", "block")})
    assert got(spark, docs, ["the river", None, "", "Same same"], digit_bits=3, block_bits=2) == want


def test_empty_tables(spark):
    assert got(spark, documents(spark, []), ["a"]) == Counter()
    docs = [(i, prose(i, 30)) for i in range(45)]
    assert got(spark, documents(spark, docs), []) == brute(docs, [])


@pytest.mark.parametrize("bits", [(1, 1), (4, 3), (11, 18)])
def test_radix_ranks(spark, bits):
    rng = random.Random(5)
    rows = [(rng.choice([-9, 0, 5, 5, 5, 1 << 40, None]), rng.randrange(-(1 << 20), 1 << 20), i) for i in range(300)]
    if bits[0] == 11:
        rows += [(-(1 << 63), 3, 300), ((1 << 63) - 1, 4, 301)]  # a distance of 64 bits
    if bits[0] == 1:
        rows = [(a, b % 7, i) for a, b, i in rows if a is None or a < 9]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(7)
    out = ir.radix_ranks(df, [("a", True), ("b", False)], *bits).collect()
    assert sorted(r.pos for r in out) == list(range(len(rows)))
    keyed = [(r.a is None, -(r.a or 0), r.b) for r in sorted(out, key=lambda r: r.pos)]
    assert keyed == sorted(keyed)


def test_passes_are_stable(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos")).repartition(5)
    out = ir._counting_pass(df.withColumn("at", F.col("pos")), F.col("k").cast("int"), 4).orderBy("pos").collect()
    assert [(r.k, r.at) for r in out] == sorted((r.k, r.at) for r in out)
