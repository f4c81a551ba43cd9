"""Columns of the input that have the names which operators use themselves come through as they are."""

import corpus_pipeline as cp
from fixtures import SF, documents, prose
from pyspark.sql import functions as F

from tidegate.llm import decontamination, host_graph, line_dedup, mixing, ngram_join
from tidegate.llm.common import keeps_columns
from tidegate.llm.queries import URL_RULES

NAMES = ("_row", "_MAYBE", "_d", "_r", "_rule", "_source", "_doc_id", "_key", "_tie", "_ordinal", "_copies", "_copy", "_k", "_t", "_o", "_guess")


def odd(spark):
    docs = documents(spark, [(i, prose(i // 2, 40), "en", "s") for i in range(6)])
    return docs.withColumns({c: F.concat(F.lit(c + " of "), F.col("doc_id").cast("string")) for c in NAMES})


def check(out, docs):
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in NAMES)
    return rows


def test_operators_keep_such_columns(spark):
    docs = odd(spark)
    assert len(check(ngram_join.deduplicated(docs), docs)) == 3
    assert len(check(line_dedup.deduplicated(docs), docs)) == 6
    bench = spark.createDataFrame([(1, prose(0, 40))], "item_id long, text string")
    assert len(check(decontamination.clean_documents(docs, bench), docs)) == 4
    check(mixing.mixed_documents(docs), docs)
    check(cp.with_a_language(spark, docs, SF), docs)
    pages = docs.withColumn("url", F.lit("http://example.org/x")).withColumn("html", F.lit("")).withColumnRenamed("doc_id", "page_id")
    out = host_graph.judged(pages, URL_RULES)
    assert [c for c in out.columns if c in NAMES] == list(NAMES) and {r["_rule"] for r in out.collect()} == {f"_rule of {i}" for i in range(6)}


def test_names_set_aside_never_meet(spark):
    @keeps_columns("a")
    def work(df):
        return df.withColumn("a", F.lit(1)).drop("a")

    df = spark.createDataFrame([(1, 2, 3)], "a int, `own a` int, `own own a` int")
    assert work(df).columns == ["a", "own a", "own own a"] and tuple(work(df).first()) == (1, 2, 3)
