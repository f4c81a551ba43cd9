"""Session set-up, the shared work folder, and look-up tables that are computed once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tested with; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # one call to the JVM for a column instead of four, as plans here have thousands
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tidegate-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidegate/{label}-{uuid.uuid4().hex}"


@dataclass
class Settled:
    """A table computed once and written to the shared folder; ``facts`` holds what was asked about it."""

    made_of: DataFrame
    table: DataFrame
    facts: dict


_settled: dict[tuple[str, int], list[Settled]] = {}


def settled(df: DataFrame) -> Settled:
    """``df`` as a written table, read back without its plan.

    The same plan is computed once in a session. Nothing here decides on broadcasts: the table's
    size in files is known to Catalyst, and a side above its threshold stays a shuffle join.
    """
    entries = _settled.setdefault((df.sparkSession.sparkContext.applicationId, df.semanticHash()), [])
    for entry in entries:
        if entry.made_of.sameSemantics(df):
            return entry
    path = scratch_path(df.sparkSession, "side")
    df.write.parquet(path)
    entry = Settled(df, df.sparkSession.read.schema(df.schema).parquet(path), {})
    entries.append(entry)
    return entry


def forget(entries: Iterable[Settled]) -> None:
    """Have the given tables computed anew when they are asked for again."""
    gone = list(entries)
    for held in _settled.values():
        held[:] = [e for e in held if not any(e is g for g in gone)]


def source_state(*tables: DataFrame | None) -> tuple:
    """Names, times and lengths of the files behind small tables: changes when one of them does."""
    found = []
    for df in tables:
        if df is None:
            continue
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for name in sorted(df.inputFiles()):
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
            status = path.getFileSystem(conf).getFileStatus(path)
            found.append((name, status.getModificationTime(), status.getLen()))
    return tuple(found)
