"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Each source is a queue of its shuffled documents, gone through up to ``repeats`` times. A document's
virtual finish time is the number of words that its queue has sent when it is done, divided by the
source's weight. Serving all queues in the order of these times is fair queueing: at any moment the
queues that are not yet empty have sent words in proportion to their weights. The order is made by one
global range sort, and cut where the budget is spent.

Running totals are taken in two steps everywhere: inside small pieces, and over the pieces' sums. The
pieces of a queue are ranges of the shuffling hash, so a source with a third of all rows is as
many small windows as it needs; those of the final order are the sorted ranges themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import keeps_columns, n_words, partitions, written

WEIGHTS, REPEATS, SEED = (1, 2, 3), 3, "mix-1"
PIECE_DIGITS = 3  # hexadecimal digits of the hash that name a piece: 4096 pieces a source


def shuffle_key():
    """A document's place in its queue: a hash of its id and text."""
    return F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, place, weight, target``: each source's share of all words.

    Sources in the order of their code points, null last, take the weights in turn. A share is cut at
    ``repeats`` times the source's size and the rest is shared anew by weight. In the order of
    cap / weight the cut sources come first, so one pass finds the level at which the others end.
    ``sizes`` has one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    placed = sizes.withColumn("place", F.row_number().over(by_name))
    placed = placed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1))
    placed = placed.withColumn("cap", F.col("source_size") * repeats)
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    left = placed.withColumn("ratio", ratio).select(
        "*",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("words_left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    level = F.col("words_left") / F.col("weight_left")
    left = left.withColumn("level", F.max(F.when(level <= F.col("ratio"), level)).over(whole))
    return left.select(
        "source", "source_size", "place", "weight",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"),
    )


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``key, tie, ordinal, doc_id, source, size, source_size, weight, target, copies, taken`` per row.

    Budget: the words of all documents. A document is taken whole or not at all, each time its queue
    comes round; the first that would pass the budget ends the mix. Null text: size 0, null source: a
    source of its own, the last. Documents of size 0 are taken when their turn comes and add nothing.
    Rows that are alike in all columns are told apart by ``ordinal``; a null id is allowed. An
    empty table gives an empty plan. The same rows in any order give the same plan.
    """
    spark = docs.sparkSession
    others = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text", "source")]
    rows = docs.select(
        F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"),
        shuffle_key().alias("key"), F.xxhash64(*others, F.lit(0)).alias("tie"),
    )
    rows = written(rows, "queue")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(sources, weights, repeats), "targets")

    piece = F.conv(F.substring("key", 1, PIECE_DIGITS), 16, 10).cast("int").alias("piece")
    queued = rows.select("*", piece)
    inside = Window.partitionBy("source", "piece").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    alike = Window.partitionBy("source", "piece", "key", "doc_id", "tie").orderBy("size")
    queued = queued.select("*", F.sum("size").over(inside).alias("sent"), F.row_number().over(alike).alias("ordinal"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.select("source", piece, "size").groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    offsets = offsets.select("source", "piece", F.coalesce(F.sum("piece_size").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(goals, offsets["source"].eqNullSafe(goals["source"])).select(
        offsets["source"], "piece", "offset", "source_size", "place", "weight", "target"
    )
    queued = queued.join(
        offsets.withColumnRenamed("source", "s").withColumnRenamed("piece", "p"),
        (F.col("piece") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")),
    )
    turns = queued.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = (F.col("turn") * F.col("source_size") + F.col("offset") + F.col("sent")) / F.col("weight")
    order = ("finish", "place", "turn", "key", "doc_id", "tie", "ordinal")
    turns = turns.select("*", finish.alias("finish")).drop("s", "p", "piece", "sent", "offset")
    dealt = turns.repartitionByRange(partitions(spark), *order).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, "order")  # fixes who sits in which range

    budget = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    parts = dealt.groupBy("range").agg(F.sum("size").alias("range_size"))
    starts = parts.select("range", F.coalesce(
        F.sum("range_size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("start"))
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    served = dealt.select("*", F.sum("size").over(within).alias("so_far")).join(F.broadcast(starts), "range")
    take = (F.col("start") + F.col("so_far") <= budget).cast("int")
    identity = ["key", "tie", "ordinal", "doc_id", "source", "size", "source_size", "weight", "target"]
    return served.groupBy(*identity).agg(F.sum(take).alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


@keeps_columns("_source", "_doc_id", "_key", "_tie", "_ordinal", "_copies", "_copy", "_k", "_t", "_o")
def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The documents of the mix, each as many times as it is taken, with the columns of ``docs``."""
    taken = plan(docs, weights, repeats).where("copies > 0").select(
        F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"),
        *[F.col(c).alias(f"_{c}") for c in ("key", "tie", "ordinal", "copies")],
    )
    others = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text", "source")]
    named = docs.select("*", shuffle_key().alias("_k"), F.xxhash64(*others, F.lit(0)).alias("_t"))
    # numbered among the rows that the plan numbers together
    alike = Window.partitionBy("source", "_k", "doc_id", "_t").orderBy(F.lit(0))
    named = named.withColumn("_o", F.row_number().over(alike))
    same = (F.col("_k") == F.col("_key")) & (F.col("_t") == F.col("_tie")) & (F.col("_o") == F.col("_ordinal"))
    same = same & F.col("source").eqNullSafe(F.col("_source")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    out = named.join(taken, same)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(docs.columns)
