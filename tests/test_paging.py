"""Pages of a sorted table against a plain sort."""

import random

import pytest

from tidegate.operators.paging import Pages


@pytest.mark.parametrize("descending", [False, True])
def test_every_page_equals_the_plain_sort(spark, descending):
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(12)]), f"c{i:03d}") for i in range(97)]
    df = spark.createDataFrame(rows, "v int, c string").repartition(5)
    first = (lambda r: (r[0] is None, -(r[0] or 0))) if descending else (lambda r: (r[0] is not None, r[0] or 0))
    want = sorted(rows, key=lambda r: (first(r), r[1]))
    pages = Pages(df, "v", descending, ("c",), ranges=6)
    assert pages.rows == 97 and len(pages.ranges) > 3
    for number in range(12):
        assert [tuple(r) for r in pages.page(number).collect()] == want[number * 10 : number * 10 + 10]
    assert [tuple(r) for r in pages.page(1, 60).collect()] == want[60:97]
    assert [tuple(r) for r in pages.last().collect()] == want[90:]


def test_a_page_reads_only_its_ranges(spark):
    pages = Pages(spark.range(10000).toDF("v"), "v", ranges=8)
    plan = pages.last()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_range#" in plan
    scanned = [b for b in range(len(pages.ranges)) if pages.ends[b] > 9990]
    assert scanned == [len(pages.ranges) - 1]


def test_empty_tables_have_empty_pages(spark):
    pages = Pages(spark.range(0).toDF("v"), "v")
    assert pages.rows == 0 and pages.page(0).collect() == [] and pages.last().collect() == [] and pages.page(3).collect() == []
