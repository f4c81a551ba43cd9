import random
import re
from collections import Counter

import pytest
from fixtures import SF, documents, prose
from pyspark.sql import functions as F

from tidegate.llm import host_rules
from tidegate.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def shrunk(failed, n):
    """Shrunk rates of hosts with these failures and documents, by the plain formula."""
    rates = [f / m for f, m in zip(failed, n)]
    mean = sum(rates) / len(rates)
    var = sum((r - mean) ** 2 for r in rates) / (len(rates) - 1) if len(rates) > 1 else 0.0
    true = var - mean * (1 - mean) * sum(1 / m for m in n) / len(n)
    strength = min(10000.0, max(1.0, mean * (1 - mean) / true - 1)) if true > 0 else 10000.0
    return [(f + mean * strength) / (m + strength) for f, m in zip(failed, n)]


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b a b a b a"), (6, "x y z x y z"), (7, "é ü ñ # $ <b>\n\né ü ñ # $ <b>\n"),
    (8, "same\nsame \nsame\n same\n\n"), (9, "w " * 30000), (10, "l" * 200000), (11, "a b c d"), (11, "a b c d a b c"),
    (None, "row without an id " * 20), (12, "tab\tbed\vfeed\fret\rurn"),
]


def test_measures_of_odd_texts(spark):
    docs = documents(spark, ODD)
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    got = host_rules.measured(docs).select("doc_id", *names).collect()
    assert Counter(map(tuple, got)) == Counter((i, *counts(t)) for i, t in ODD)


def test_measures_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: tuple(r)[2:] for r in host_rules.measured(docs).collect()}
    assert got == {r.doc_id: counts(r.text) for r in docs.collect()}


def hosts_of(spark):
    """A bad host, good ones, a small one with one bad document, and documents without a host."""
    rows, at = [], 0
    for host, good, bad in [("bad", 2, 58), ("good1", 60, 1), ("good2", 50, 0), ("good3", 70, 2), ("small", 0, 1), (None, 3, 30)]:
        for k in range(good + bad):
            rows.append((at, prose(at, 80) if k < good else "too short", None, host))
            at += 1
    return rows


def test_rates_and_verdicts(spark):
    rows = hosts_of(spark)
    docs = documents(spark, rows)
    rates = {r.host: r for r in host_rules.host_rates(host_rules.measured(docs)).collect()}
    names = sorted(rates)
    want = shrunk([rates[h].short_failed for h in names], [rates[h].n_docs for h in names])
    assert [rates[h].short_rate for h in names] == pytest.approx(want)
    assert (rates["bad"].n_docs, rates["bad"].short_failed) == (60, 58)
    assert abs(rates["small"].short_rate - 1) > abs(rates["bad"].short_rate - 58 / 60)  # little is known of it

    out = {r.doc_id: r for r in host_rules.judged(docs).collect()}
    for i, text, _, host in rows:
        assert out[i].base_failed == (text == "too short")
        assert out[i].host_blocked == (host is not None and rates[host].short_rate > 0.5)
        assert out[i].kept == (not out[i].base_failed and not out[i].host_blocked)
    assert {rows[i][3] for i in out if out[i].host_blocked} >= {"bad"}
    assert all(out[i].kept for i, text, _, host in rows if text != "too short" and host != "bad")


def test_chance_alone_moves_no_host(spark):
    """Hosts that differ by chance only are shrunk to the common rate."""
    rng = random.Random(4)
    rows = [(i, "too short" if rng.random() < 0.2 else prose(i, 60), None, f"h{i % 30}") for i in range(300)]
    rates = host_rules.host_rates(host_rules.measured(documents(spark, rows))).toPandas()
    raw = rates.short_failed / rates.n_docs
    assert rates.short_rate.std() < raw.std() / 2


def test_hot_host_is_dealt_out(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("few words").alias("text"), F.lit(None).cast("string").alias("lang"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id"))).alias("source"), F.lit(9).alias("n_chars"),
    )
    out = host_rules.judged(docs)
    assert out.where("host_blocked").count() == out.count() == 3000


def test_empty_tables_and_extra_columns(spark):
    assert host_rules.judged(documents(spark, [])).collect() == []
    only_null = host_rules.judged(documents(spark, [(1, None, None, None), (1, None, None, None)])).collect()
    assert [(r.base_failed, r.host_blocked, r.kept) for r in only_null] == [(True, False, False)] * 2
    one = host_rules.judged(documents(spark, [(1, prose(1, 60), None, "only")])).collect()
    assert [r.kept for r in one] == [True]
    taken = ("host", "w", "l", "n_words", "part", "of_host", "blocked", "kept", "chance")
    docs = documents(spark, [(i, prose(i, 60), None, "s") for i in range(5)]).withColumns({c: F.lit("x") for c in taken})
    assert host_rules.judged(docs).where("kept").count() == 5
    renamed = docs.drop("host").withColumnsRenamed({"source": "site", "text": "body", "doc_id": "id"})
    assert host_rules.judged(renamed, host="site", text="body", key="id").where("kept").count() == 5


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = host_rules.measured(docs)._jdf.queryExecution().toString() + QUERIES["op13_host_rules"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
