"""The queries of this folder over the test tables; ``oracles`` holds those that SQL can say too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    decontamination,
    embedding_dedup,
    host_graph,
    host_rules,
    importance_resampling,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    spelling_variants,
    token_files,
    toxicity,
    warc_revisits,
)
from tidegate.llm.common import table
from tidegate.llm.oracles import ORACLES
from tidegate.runtime import scratch_path

URL_RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
)
TOKENIZER = "word_bpe_49k.json"
HELD_OUT = 2


def captures(pages: DataFrame) -> DataFrame:
    """WARC records of the pages: a capture of each, two later revisits and one before it.

    Dates, validators and headers follow from the page's id and content, so some revisits carry
    other validators, some none, and spellings of one URL meet.
    """
    page, k = F.col("page_id"), F.col("k")
    digest = F.md5(F.coalesce("html", F.lit("")))
    start = F.lit(1704067200) + (page % 97) * 3600
    rows = pages.select("page_id", "url", digest.alias("digest"), F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
    seconds = start + F.when(k == 0, 0).when(k == 1, 18000).when(k == 2, 36000).otherwise(-86400)
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 8), F.lit('"'))
    etag = (
        F.when(page % 5 == 4, None).when((k == 2) & (page % 3 == 0), '"changed"')
        .when(k == 2, F.concat(F.lit("W/"), tag)).otherwise(tag)
    )
    modified = F.when(page % 7 != 6, F.concat(F.lit("day "), (page % 31).cast("string")))
    headers = F.map_filter(F.create_map(
        F.lit("etag"), etag, F.lit("date"), seconds.cast("string"),
        F.lit("cache-control"), F.concat(F.lit("max-age="), (60 * k).cast("string")),
        F.lit("content-type"), F.when(k == 0, "text/html").otherwise("message/http"),
        F.lit("set-cookie"), F.concat(F.when(k == 0, "page=").otherwise("visit="), page.cast("string")),
    ), lambda name, value: value.isNotNull())
    return rows.select(
        (page * 4 + k).alias("record_id"), F.when(k == 0, "response").otherwise("revisit").alias("warc_type"), "url",
        F.timestamp_seconds(seconds).alias("date"),
        F.when((k == 0) & (page % 17 == 0), 404).when(k == 0, 200).otherwise(304).alias("status"),
        etag.alias("etag"), modified.alias("last_modified"), "digest", headers.alias("headers"),
    )


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve(captures(table(spark, sf_dir, "pages")))
    seconds = lambda c: F.unix_timestamp(c)
    names = ("etag", "cache-control", "content-type", "set-cookie", "date")
    return found.select(
        "record_id", "url_key", seconds("date").alias("ts"), "refers_to", seconds("refers_to_date").alias("refers_to_ts"),
        "outcome", "digest", *[F.col("headers")[n].alias("h_" + n.replace("-", "_")) for n in names],
    )


def op2_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = host_graph.judged(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.lit(1) - F.col("quality")).alias("junk"), "toxic")
    model = toxicity.train(docs, labels, ["junk", "toxic"])
    scored = docs.select("doc_id", toxicity.scores(F.col("text"), model).alias("p"))
    return scored.select(
        "doc_id", F.col("p")[0].alias("junk_score"), F.col("p")[1].alias("toxic_score"),
        (F.col("p")[1] >= toxicity.THRESHOLD).alias("toxic"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept", "n_copies")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_copies")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed", F.md5("text").alias("kept_md5")
    )


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.plan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_files.index(spark, path)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "matched", "changed", "doc_start", "doc_end")


def held_out():
    """Documents that nothing is learned from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    guess = language_id.predicted(F.col("text"), model)
    found = docs.select("doc_id", held_out().alias("held_out"), guess.alias("g"))
    return found.select("doc_id", "held_out", F.col("g.lang").alias("lang_pred"), F.col("g.score").alias("score"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source, as the table has no addresses."""
    found = host_rules.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_blocked"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_revisits, op2_host_graph, op3_toxicity_chain, op4_embedding_dedup, op5_ngram_join, op6_line_dedup,
        op7_source_mixing, op8_token_files, op9_decontamination, op10_language_id, op11_spelling_variants, op12_importance_resampling,
        op13_host_rules,
    )
}
__all__ = ["ORACLES", "QUERIES"]
