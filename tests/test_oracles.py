"""Every registered query against its SQL counterpart at the smallest scale."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tidegate.plans.sample_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in entry.oracle_sql()
    assert difference(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_queries_run_where_workers_lack_the_package(tmp_path):
    """From another folder Python workers can't import the package: what they run travels with the job."""
    import os
    import subprocess
    import sys

    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "compare.py")
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = ["foreign_layers", "binary_layers", "rule_list", "bundle_scan", "merge_layers"]
    done = subprocess.run([sys.executable, script, "sf0.001", *names], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=600)
    assert "different: 0" in done.stdout, done.stdout
