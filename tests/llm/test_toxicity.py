import numpy as np
from fixtures import SF, documents, prose
from pyspark.sql import functions as F

from tidegate.llm import toxicity as tx
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES


def labelled(spark, n=400):
    rows = []
    for i in range(n):
        insult, threat = i % 4 == 0, i % 8 == 0 or i % 16 == 5
        text = prose(i, 40) + (" you idiot" if insult else "") + (" i will hurt" if threat else "")
        rows.append((i, text, int(insult), int(threat)))
    return spark.createDataFrame(rows, "doc_id long, text string, insult int, threat int")


def test_the_chain_learns_and_feeds_earlier_probabilities(spark):
    rows = labelled(spark)
    model = tx.train(rows, rows, ["insult", "threat"])
    assert [len(m[2]) for m in model["models"]] == [1, 2]  # a constant; one earlier category and a constant
    got = np.array(tx.probabilities([prose(9000, 40), prose(9001, 40) + " You IDIOT!", prose(9002, 40) + " i will hurt"], model)) >= 0.5
    assert got.tolist() == [[False, False], [True, False], [False, True]]


def test_whole_tables_on_held_out_labels(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    half = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    pairs = docs.join(labels, "doc_id").withColumn("junk", 1 - F.col("quality"))
    model = tx.train(docs, pairs.where(half), ["junk", "toxic"])
    rest = pairs.where(~half).select("toxic", "junk", tx.scores(F.col("text"), model).alias("p")).collect()
    flagged = [r.p[1] >= tx.THRESHOLD for r in rest]
    hit = [f for f, r in zip(flagged, rest) if r.toxic]
    assert np.mean(hit) >= 0.9
    assert sum(f and not r.toxic for f, r in zip(flagged, rest)) <= 0.002 * len(rest)


def test_odd_rows_and_constant_labels(spark):
    rows = [(1, None, 1, 0), (2, "a text", None, 0), (3, "a text", 0, 0), (3, "a text", 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, insult int, threat int").selectExpr("*", "1 as y0", "2 as place", "'w' as weight", "0 as fold")
    model = tx.train(df, df, ["insult", "threat"])
    p = tx.probabilities([None, "", "a text", "x " * 100_000], model)
    assert p.shape == (4, 2) and (p < 0.5).all()
    assert (tx.probabilities(["a text"], tx.train(df.where("doc_id < 0"), df, ["insult", "threat"])) <= 0.5).all()
    empty = tx.train(df, df.where("doc_id < 0"), ["insult", "threat"])
    assert (tx.probabilities([None, "text"], empty) == 0).all()
    docs = documents(spark, [(1, None), (2, "x")]).selectExpr("*", "1 as p")
    assert [len(r.q) for r in docs.select("*", tx.scores(F.col("text"), model).alias("q")).collect()] == [2, 2]


def test_query_scores_every_document(spark):
    found = QUERIES["op3_toxicity_chain"](spark, SF)
    assert found.count() == table(spark, SF, "documents").count()
