import pytest
from compare import connect, difference
from fixtures import SF, documents, prose

from tidegate.llm import mixing
from tidegate.llm.common import table
from tidegate.llm.oracles import ORACLES
from tidegate.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_agree_with_sql(spark, name):
    assert difference(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


def skewed(spark):
    rows = [(i, prose(i, 20 + i % 40), "en", "a" if i % 3 else "b") for i in range(300)]
    rows += [(1000 + i, prose(i, 7), "en", "Z") for i in range(4)] + [(2000, prose(1, 9), None, None), (2001, None, None, "b"), (None, "x y z", None, "a")]
    return documents(spark, rows)


def test_shares_targets_and_reruns(spark):
    docs = skewed(spark)
    plan = mixing.plan(docs).collect()
    assert len(plan) == docs.count()
    total = sum(r.size for r in plan)
    by = {}
    for r in plan:
        one = by.setdefault(r.source, {"size": 0, "taken": 0, "target": r.target, "source_size": r.source_size, "weight": r.weight})
        one["size"] += r.size
        one["taken"] += r.taken
        assert 0 <= r.copies <= 3
        assert r.taken == r.copies * r.size
    # by code point: Z, a, b, then null: weights 1, 2, 3, 1
    assert {s: v["weight"] for s, v in by.items()} == {"Z": 1, "a": 2, "b": 3, None: 1}
    assert all(v["size"] == v["source_size"] for v in by.values())
    assert sum(v["target"] for v in by.values()) == pytest.approx(total)
    assert by["Z"]["target"] == 3 * by["Z"]["size"] and by[None]["target"] == 3 * by[None]["size"]
    for v in by.values():
        assert abs(v["taken"] - v["target"]) <= 2 * 60
    again = mixing.plan(docs.repartition(7)).collect()
    key = lambda r: (r.key, r.tie, r.ordinal)
    assert sorted(plan, key=key) == sorted(again, key=key)


def test_documents_of_the_mix(spark):
    docs = skewed(spark).selectExpr("*", "1 as key", "2 as size", "3 as copies", "'t' as target")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = {(r.doc_id, r.source): r.copies for r in mixing.plan(docs).collect() if r.copies}
    got = {}
    for r in out.collect():
        got[(r.doc_id, r.source)] = got.get((r.doc_id, r.source), 0) + 1
    assert got == want


def test_repeated_rows_empty_texts_and_empty_table(spark):
    rows = [(1, "a b c", None, "s")] * 5 + [(2, "", None, "s"), (3, None, None, None)]
    plan = mixing.plan(documents(spark, rows)).collect()
    assert len(plan) == 7 and sum(r.taken for r in plan) == 15
    assert mixing.mixed_documents(documents(spark, rows)).where("doc_id = 1").count() == 5
    blank = mixing.plan(documents(spark, [(1, None), (2, "  ")])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0), (0, 0.0, 0)]
    empty = table(spark, SF, "documents").where("doc_id < 0")
    assert mixing.plan(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_rows_that_differ_in_source_only(spark):
    rows = [(1, "a b", None, "s"), (1, "a b", None, "t"), (None, "d e", None, None), (None, "d e", None, "s")]
    docs = documents(spark, rows)
    want = {(r.doc_id, r.source): r.copies for r in mixing.plan(docs, (1, 1)).collect() if r.copies}
    got = {}
    for r in mixing.mixed_documents(docs, (1, 1)).collect():
        got[(r.doc_id, r.source)] = got.get((r.doc_id, r.source), 0) + 1
    assert got == want and {(1, "s"), (1, "t")} <= set(want)
