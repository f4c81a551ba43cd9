"""Structured Streaming around the batch plans.

Every micro-batch runs the batch plan on the files or rows that arrived, writes its results into folders of its
own, and shows them by one rename. A batch that is repeated after a failure writes them anew, or, if it had been
shown already, does nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators import counts, publish, report
from tidegate.operators.references import References
from tidegate.plans.validate import validate
from tidegate.sources import bundles as deliveries
from tidegate.sources import sinks, snapshots

RESULTS = ("contents", "bundles", "lines", "failures", "counts", "summaries", "geopackages", "updates")


def landing_stream(spark: SparkSession, path: str, pattern: str = "*.zip", files_a_batch: int | None = None) -> DataFrame:
    """Delivered files as they land."""
    reader = spark.readStream.format("binaryFile").schema(deliveries.FILE_SCHEMA).option("pathGlobFilter", pattern)
    return (reader if files_a_batch is None else reader.option("maxFilesPerTrigger", files_a_batch)).load(path)


def stage_files(files: DataFrame, refs: References, root: str, batch: str) -> DataFrame:
    """Validate delivered files and write every result of the batch; returns the delivered bundles, readable or not.

    Nothing of it is seen before the batch is committed. The decoded records, the count lines and the failures are written
    first and read back, so that nothing is decoded, counted or checked twice and a lost executor costs one stage, not the chain.
    """
    put = lambda df, table, **how: snapshots.stage(df, root, table, batch, **how)
    contents = put(deliveries.bundle_contents(files), "contents", together=True)
    records, every = deliveries.records_of(contents), put(deliveries.info_of(contents), "bundles")
    info = every.where(F.col("error").isNull())
    lines = put(counts.count_lines(records, refs, info), "lines")
    result = validate(records, refs, bundles=info, approvals=info, lines=lines)
    found = put(result.failures, "failures", together=True)
    put(result.counts, "counts")
    summary = put(report.bundle_summary(info, found, info), "summaries")
    gated = publish.with_geometry(publish.gate(records, refs, summary))
    put(publish.export_columns(publish.expand_criteria(gated, refs, info), keep=["bundle"]), "geopackages", together=True)
    updates = publish.status_rows(refs, summary, F.current_timestamp())
    put(updates.withColumn("bundle", F.col("databundelcode")), "updates")
    return every.select("bundle")


def process_files(files: DataFrame, refs: References, root: str, version: int | None = None) -> DataFrame:
    """Validate delivered files and make their results the current ones below ``root``; returns the bundle summary.

    A delivery replaces all results of an earlier one of its bundle, whatever comes of it: also those of a file that
    can't be read go. Until all results are written the earlier ones stay to be seen. The same ``version`` given again
    changes nothing that has been shown.
    """
    spark = files.sparkSession
    batch = f"m{uuid.uuid4().hex}" if version is None else f"s{version}"
    if not snapshots.committed(spark, root, batch):
        snapshots.commit(spark, root, stage_files(files, refs, root, batch), batch)
    staged = lambda table: spark.read.parquet(f"{root}/{table}/batch={batch}")
    sinks.status_table(spark, f"{root}/status").merge(batch, staged("updates").drop("bundle"), publish.upsert_status)
    return staged("summaries")


def ingest(files: DataFrame, refs: References, root: str, available_now: bool = True) -> StreamingQuery:
    """Run ``process_files`` on every batch of a stream of files."""

    def run(batch: DataFrame, batch_id: int) -> None:
        refs.refresh()
        process_files(batch, refs, root, batch_id)

    writer = files.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def follow_status(updates: DataFrame, order: str, root: str, available_now: bool = True) -> StreamingQuery:
    """Keep the status table at the latest update per bundle, in whatever order they arrive.

    ``updates`` is a stream of ``(databundelcode, krmcriterium, last_updated, status)`` plus the
    column ``order`` that ranks updates of one bundle.
    """
    spark = updates.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        sinks.write_status(spark, root, sinks.latest_updates(batch, order), batch_id, order)

    writer = updates.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}-checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def publish_stream(layers: DataFrame, out: str, order: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Keep the published dataset at the latest delivery of every bundle, as exported layers arrive.

    ``layers`` is a stream with ``bundle`` and, if bundles can be withdrawn, ``withdrawn``; ``order`` names a column that
    ranks deliveries of one bundle. ``sinks.published_rows`` reads the dataset.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        sinks.publish_batch(batch, out, f"s{batch_id}", order)

    writer = layers.writeStream.foreachBatch(run).option("checkpointLocation", f"{out}-checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
