import numpy as np
from fixtures import SF, documents
from pyspark.sql import functions as F

from tidegate.llm import language_id as li
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    found = QUERIES["op10_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == table(spark, sf, "documents").count()


def test_families_come_first(spark):
    model = li.train(table(spark, SF, "documents"))
    assert set(model["machines"]) == {"germanic|romance", "de|en", "es|fr"}
    assert li.family("xx") == "only xx" and li.family("pt-BR") == "romance"


def test_odd_texts_and_columns(spark):
    model = li.train(table(spark, SF, "documents"))
    rows = [(1, None), (2, ""), (3, " 123 ?! \n"), (4, "the and with that from this"), (5, "é" * 100_000), (6, "q")]
    docs = documents(spark, rows).selectExpr("*", "1 as score", "'a' as g")
    got = {r.doc_id: r.p for r in docs.select("*", li.predicted(F.col("text"), model).alias("p")).collect()}
    assert all((got[i].lang, got[i].score) == ("und", 0.0) for i in (1, 2, 3))
    assert got[4].lang == "en" and got[5].lang in model["languages"] and got[6].lang in model["languages"]


def test_small_training_tables(spark):
    nothing = li.train(documents(spark, [(1, None, "en"), (2, "text", None), (3, "12", "en")]))
    assert li.predict(["some text"], nothing)[0] == ["en"]  # the only language known
    assert li.predict(["some text"], li.train(documents(spark, [(1, None, "en")])))[0] == ["und"]
    one = li.train(documents(spark, [(1, "some text", "xx"), (1, "some text", "xx")]))
    names, scores = li.predict(["a text", None], one)
    assert names == ["xx", "und"] and scores.tolist() == [1.0, 0.0]
    two = li.train(documents(spark, [(1, "some text", "en"), (2, "einige worte", "de")]))
    assert li.predict(["some text", "einige worte"], two)[0] == ["en", "de"]


def test_copies_do_not_shrink_the_sample(spark):
    rows = [(i, f"the words of text {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}", "en") for i in range(300)]
    rows += [(1000 + i, f"die worte im satz {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}", "de") for i in range(300)]
    rows += [(9000 + i, "one and the same text", "en") for i in range(60_000)] + [(8000, "12", "en"), (8001, "??", "en")]
    model = li.train(documents(spark, rows), sample=40)
    assert set(model["machines"]) == {"de|en"}
    assert li.predict(["the words of text", "die worte im satz"], model)[0] == ["en", "de"]


def test_machines_are_trained_without_copies_of_the_sample():
    """Rows stay as narrow as they come; the weights are those of rows that are widened at once."""
    import tracemalloc

    rng = np.random.default_rng(2)
    x = np.abs(rng.normal(size=(2000, li.DIMENSIONS))).astype(np.float16)
    y = np.where(np.arange(2000) % 3 == 0, 1.0, -1.0)
    x[y > 0, :50] += np.float16(2)
    tracemalloc.start()
    try:
        w = li.support_vector_machine(x, y, rounds=2)
        assert tracemalloc.get_traced_memory()[1] < 2 << 20
    finally:
        tracemalloc.stop()
    assert (w == li.support_vector_machine(x.astype(np.float64), y, rounds=2)).all() and ((x[:50] @ w[:-1] + w[-1] > 0) == (y[:50] > 0)).all()
