"""One query per operator over the test tables; ``sample_oracles`` holds the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import geo, labels, projections, text, wkb
from tidegate.operators import (
    collections,
    counts,
    issues,
    matching,
    publish,
    rank,
    report,
    row_checks,
    status,
)
from tidegate.operators.references import normalise_rules
from tidegate.plans import sample_views as sv
from tidegate.plans.validate import run_checks, validate
from tidegate.runtime import scratch_path, settled
from tidegate.sources import bundles as deliveries
from tidegate.sources import files as stored
from tidegate.sources import sinks, snapshots, tables
from tidegate.streaming import ingest

CURRENT_YEAR = 2025
TODAY = "2025-06-01"
KEYS = ("k1", "k2", "k3", "k4")
FAILURE = ("section", "databundelcode", "record_id", "uitvalreden", "informatie")


def _row_check(*checks: str, scale: bool = False) -> Callable:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        refs = sv.references(spark, sf, scale)
        found = row_checks.row_failures(sv.records(spark, sf), refs, checks, sv.bundle_names(spark, sf))
        return found.select(*FAILURE)

    return query


def rule_selection(spark: SparkSession, sf: str) -> DataFrame:
    chosen = sv.references(spark, sf).select_rules(sv.bundle_names(spark, sf))
    return chosen.select("bundle", "rule_id", "databundelcode")


def rules_exploded(spark: SparkSession, sf: str) -> DataFrame:
    refs = sv.references(spark, sf, scale=True)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return refs.exploded(refs.rules).select("rule_id", "locatiecode", day("startdatum"), day("einddatum"))


def _rule_match(scale: bool) -> Callable:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        refs = sv.references(spark, sf, scale)
        found = matching.assignments(sv.records(spark, sf), refs, sv.bundle_names(spark, sf))
        ids = F.concat_ws(";", F.transform("mogelijke_validatieregels", lambda i: i.cast("string")))
        return found.withColumn("mogelijke_validatieregels", ids)

    return query


def groups_for_rules(spark: SparkSession, sf: str) -> DataFrame:
    return matching.groups_for_rules(sv.view(spark, sf, sv.GROUPS), sv.view(spark, sf, sv.RULES))


def collection_flag(spark: SparkSession, sf: str) -> DataFrame:
    refs = sv.references(spark, sf)
    known = matching.with_rulesets(sv.records(spark, sf), refs, sv.bundle_names(spark, sf))
    counted = matching.with_memberships(known, refs).where(F.col("ruleset").isNotNull())
    flag = F.when(F.col("n_groups") > 1, 1).otherwise(0).alias("betreftverzameling")
    return counted.select(*KEYS, "parameter_key", "n_groups", flag)


def polygon_distance(spark: SparkSession, sf: str) -> DataFrame:
    refs = sv.references(spark, sf)
    refs.points, refs.rings = None, sv.view(spark, sf, sv.RINGS)
    known = matching.with_rulesets(sv.records(spark, sf), refs, sv.bundle_names(spark, sf))
    placed = row_checks.with_locations(known, refs).where(F.col("_known_location").isNotNull())
    found = row_checks.with_distances(placed, refs)
    return found.select(*KEYS, F.explode("_metres_more").alias("d")).select(*KEYS, F.round("d", 3).alias("distance"))


def _lines(spark: SparkSession, sf: str, scale: bool, **settings) -> tuple[DataFrame, object]:
    refs = sv.references(spark, sf, scale, **settings)
    return counts.count_lines(sv.records(spark, sf), refs, sv.bundle_names(spark, sf)), refs


def count_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf, True)[0].drop("bundle")


def count_reconciliation_samples(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf, False)[0].drop("bundle")


def count_reconciliation_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf, True, compat=False)[0].drop("bundle")


def count_reconciliation_samples_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf, False, compat=False)[0].drop("bundle")


def count_report(spark: SparkSession, sf: str) -> DataFrame:
    return counts.count_report(*_lines(spark, sf, True)).drop("bundle")


def parameter_check(spark: SparkSession, sf: str) -> DataFrame:
    refs = sv.references(spark, sf)
    found = collections.parameter_failures(
        sv.records(spark, sf), refs, (0, 5), sv.bundle_names(spark, sf)
    )
    return found.select(*FAILURE, "copies")


def collection_groups(spark: SparkSession, sf: str) -> DataFrame:
    refs = sv.references(spark, sf)
    found = collections.collection_parameters(sv.records(spark, sf), refs, sv.bundle_names(spark, sf))
    return found.drop("bundle")


def _collections(mode: str) -> Callable:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        refs = sv.references(spark, sf)
        found = collections.collection_failures(sv.records(spark, sf), refs, mode, sv.bundle_names(spark, sf))
        return found.select(*FAILURE)

    return query


def _all_failures(spark: SparkSession, sf: str) -> DataFrame:
    refs = sv.references(spark, sf)
    return run_checks(sv.delivered(spark, sf), refs, bundles=sv.bundle_names(spark, sf))


def failures_all(spark: SparkSession, sf: str) -> DataFrame:
    return report.ordered(_all_failures(spark, sf))


def failures_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """All ten families of checks in the corrected behaviour, counted by bundle, section and reason."""
    refs = sv.references(spark, sf, compat=False)
    found = run_checks(sv.delivered(spark, sf), refs, bundles=sv.bundle_names(spark, sf))
    return found.groupBy("databundelcode", "section", "uitvalreden").agg(
        F.count("*").alias("failures"), F.countDistinct("record_id").alias("records")
    )


def failures_by_section(spark: SparkSession, sf: str) -> DataFrame:
    return report.by_section(_all_failures(spark, sf))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    approvals = sv.view(spark, sf, sv.APPROVALS)
    return report.bundle_summary(sv.bundle_names(spark, sf), _all_failures(spark, sf), approvals)


def bundle_summary(spark: SparkSession, sf: str) -> DataFrame:
    entries = F.transform(
        F.array_sort(F.map_entries("failures_by_section")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    sections = F.concat_ws(";", entries).alias("failures_by_section")
    return _summary(spark, sf).select(
        "bundle", "bundle_valid", "has_akkoord", "validation_failures", sections, report.status_text().alias("status")
    )


def sample_dense_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rank.sample_dense_rank(sv.records(spark, sf))


def _expanded(spark: SparkSession, sf: str) -> DataFrame:
    return publish.expand_criteria(sv.records(spark, sf), sv.references(spark, sf), sv.bundle_names(spark, sf))


def criteria_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return _expanded(spark, sf).select(*KEYS, "bundle", "krmcriterium", "monprog_naam")


def export_projection(spark: SparkSession, sf: str) -> DataFrame:
    coordinates = {"geometriepunt_x": F.col("lon").cast("string"), "geometriepunt_y": F.col("lat").cast("string")}
    pointed = publish.with_geometry(sv.records(spark, sf))
    wide = publish.expand_criteria(pointed, sv.references(spark, sf), sv.bundle_names(spark, sf))
    shaped = publish.export_columns(wide.withColumns(coordinates), dotted=False, keep=["bundle"])
    read = shaped.withColumn("xy", wkb.point_xy("geom"))
    return read.withColumns({"geom_x": F.col("xy.x"), "geom_y": F.col("xy.y")}).drop("geom", "xy")


def export_gate(spark: SparkSession, sf: str) -> DataFrame:
    result = validate(
        sv.delivered(spark, sf),
        sv.references(spark, sf),
        bundles=sv.bundle_names(spark, sf),
        approvals=sv.view(spark, sf, sv.APPROVALS),
    )
    names = {"meetwaarde.lokaalid": "meetwaarde_lokaalid", "monprog.naam": "monprog_naam"}
    return result.export.withColumnsRenamed(names).select(
        "bundle", "meetwaarde_lokaalid", "krmcriterium", "monprog_naam"
    )


def _layers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two exported layers with different columns, one of every other bundle, the second in projected coordinates."""
    m = sv.records(spark, sf)
    odd = F.substring("bundle", 1, 1).cast("int") % 2 == 1
    first = m.where(odd).select(
        "meetwaarde_lokaalid", F.col("grootheid_code").alias("Grootheid_code"), "lon", "lat", F.lit(geo.LONLAT).alias("crs")
    )
    east, north = geo.to_utm31("lon", "lat")
    second = m.where(~odd).select(
        "meetwaarde_lokaalid",
        F.col("bemonsteringsapparaat_omschrijving").alias("apparaat"),
        F.col("parameter_code").alias("parameter"),
        east.alias("lon"),
        north.alias("lat"),
        F.lit(geo.UTM31).alias("crs"),
    )
    return first, second


def _rounded(published: DataFrame) -> DataFrame:
    return published.withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


def merge_layers(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(publish.merge_layers(*_layers(spark, sf)))


def _stamp(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def status_upsert(spark: SparkSession, sf: str) -> DataFrame:
    target = sv.view(spark, sf, sv.STATUS).withColumn("last_updated", _stamp("last_updated")).drop("ord")
    updates = sv.view(spark, sf, sv.UPDATES).withColumn("last_updated", F.lit("2025-01-01 12:00:00"))
    return publish.upsert_status(target, updates)


def _status(spark: SparkSession, sf: str) -> DataFrame:
    return status.parse_status(sv.view(spark, sf, sv.STATUS))


def status_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf).withColumn("last_updated", _stamp("last_updated")).drop("akkoord_reden", "ord")


def planning_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return status.dedupe_planning(sv.view(spark, sf, sv.PLANNING))


def latest_delivery(spark: SparkSession, sf: str) -> DataFrame:
    latest = status.latest_deliveries(_status(spark, sf))
    return latest.select("base_databundelcode", "databundelcode", "krmcriterium", _stamp("last_updated"), "validation", "approval")


def _overview(spark: SparkSession, sf: str) -> DataFrame:
    return status.status_overview(
        _status(spark, sf), planning_dedupe(spark, sf), sv.view(spark, sf, sv.PUBLISHED)
    )


def status_overview(spark: SparkSession, sf: str) -> DataFrame:
    return _overview(spark, sf).withColumn("last_updated", _stamp("last_updated")).drop("akkoord_reden")


def status_filter_search_page(spark: SparkSession, sf: str) -> DataFrame:
    chosen = status.filter_overview(
        _overview(spark, sf), status=labels.COMPLIES, delivery=status.DELIVERED, year=2023
    )
    shown = status.page(status.search_overview(chosen, "MACH"), "databundelcode", descending=True, number=1, size=5)
    return shown.select("databundelcode", "krmcriterium", "leverdatum", "combined_status", "publication_status")


def overview_last_page(spark: SparkSession, sf: str) -> DataFrame:
    """The last page of the whole overview, of which only the last range is read."""
    shown = status.pages(_overview(spark, sf), "databundelcode", descending=True).last(25)
    return shown.select("databundelcode", "krmcriterium", "leverdatum", "combined_status", "publication_status")


def status_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows whose columns are spelled in three ways; the first filled one counts, rows without a code go."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    kind, code = F.col("o_orderkey") % 5, F.concat(F.lit("B_"), F.col("o_custkey").cast("string"))
    cell = lambda wanted, value: F.when(kind.isin(*wanted), value).otherwise(F.when(kind == 4, "").cast("string"))
    rows = orders.select(
        cell((0, 3), code).alias("databundelcode"), cell((1, 3), F.concat(code, F.lit("+x"))).alias("data_bundle_code"),
        cell((2,), F.concat(code, F.lit("+y"))).alias("Data Bundle Code"), cell((1,), F.col("o_orderpriority")).alias("krm_criterium"),
        cell((0, 1, 2), F.lit("late")).alias("KRM Criterium"), F.concat(F.lit("day "), (F.col("o_orderkey") % 31).cast("string")).alias("updated"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, "yes").otherwise("no").alias("validation"), F.lit("1").alias("approval"), F.col("o_orderkey").alias("ord"),
    )
    return status.parse_status(rows).drop("akkoord_reden")


def failure_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Failures found elsewhere join the table; a list that lacks a column is refused."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    named = orders.select(
        F.col("o_orderpriority").alias("databundelcode"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("NL80_"), F.col("o_orderkey").cast("string"))).alias("record_id"),
        F.col("o_orderstatus").alias("uitvalreden"), F.concat(F.lit("day "), (F.col("o_orderkey") % 31).cast("string")).alias("informatie"), F.col("o_orderdate").alias("extra"),
    )
    found = report.intake("Externe controle", named)
    try:
        report.intake("Externe controle", named.drop("informatie"))
    except ValueError as refused:
        told = {"section": "refused", "uitvalreden": str(refused)}
        return found.unionByName(spark.range(1).select(*[F.lit(told.get(c)).cast("string").alias(c) for c in found.columns]))
    raise AssertionError("a list without a column was taken")


def count_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """The count report of every bundle as a file under its own name, each read again by the bundle's code."""
    folder = scratch_path(spark, "count-reports")
    rows = settled(counts.count_report(*_lines(spark, sf, True))).table
    names = [r["bundle"] for r in sv.bundle_names(spark, sf).select("bundle", labels.count_report_name("bundle").alias("n")).collect()]
    read = []
    for bundle in sorted(names):
        file = spark.range(1).select(labels.count_report_name(F.lit(bundle)).alias("n")).first()["n"]
        sinks.write_count_report_csv(rows.where(F.col("bundle") == bundle), f"{folder}/{file}")
        read.append(tables.read_count_report(spark, folder, bundle).drop("ord"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def published_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Two exported layers in the folder of the test environment, published, and published again after one was withdrawn."""
    root = scratch_path(spark, "published-layers")
    first, second = (layer.toDF(*[c.lower() for c in layer.columns]) for layer in _layers(spark, sf))
    for name, layer in (("first", first), ("second", second)):
        snapshots.stage(layer.withColumn("bundle", F.lit(name)), root, "geopackages", name)
        snapshots.commit(spark, root, spark.createDataFrame([(name,)], "bundle string"), name)
    sinks.publish(spark, root, f"{root}/published")
    all_rows = settled(_rounded(sinks.published_rows(spark, f"{root}/published")).withColumn("state", F.lit("both"))).table
    snapshots.withdraw(spark, root, spark.createDataFrame([("first",)], "bundle string"), "withdrawal")
    sinks.publish(spark, root, f"{root}/published")
    rest = _rounded(sinks.published_rows(spark, f"{root}/published")).withColumn("state", F.lit("withdrawn"))
    columns = ("state", "bundle", "meetwaarde_lokaalid", "lon", "lat")
    return all_rows.select(*columns).unionByName(rest.select(*columns))


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return status.kpis(_overview(spark, sf))


def filter_options(spark: SparkSession, sf: str) -> DataFrame:
    return status.criterium_options(_overview(spark, sf))


def year_options(spark: SparkSession, sf: str) -> DataFrame:
    return status.year_options(_overview(spark, sf), CURRENT_YEAR)


def issue_details(spark: SparkSession, sf: str) -> DataFrame:
    return issues.issue_details(count_report(spark, sf))


def issue_summary(spark: SparkSession, sf: str) -> DataFrame:
    return issues.issue_summary(issue_details(spark, sf))


def issue_totals(spark: SparkSession, sf: str) -> DataFrame:
    return issues.issue_totals(issue_details(spark, sf))


def next_steps(spark: SparkSession, sf: str) -> DataFrame:
    return issues.next_steps(issue_totals(spark, sf), TODAY)


def issue_bundles(spark: SparkSession, sf: str) -> DataFrame:
    approvals = sv.view(spark, sf, sv.APPROVALS).select(
        F.col("bundle").alias("databundelcode"),
        F.lit("ANSNL-D1C1").alias("krmcriterium"),
        labels.combined_status(F.lit(False), F.col("approved"), F.lit(True)).alias("combined_status"),
    )
    found = issues.issues_with_bundle(issue_details(spark, sf), approvals)
    return found.select("databundelcode", "record_id", "location", "severity", "krmcriterium", "combined_status")


def display_dates(spark: SparkSession, sf: str) -> DataFrame:
    from tidegate.functions import dates

    return _overview(spark, sf).select(
        F.coalesce("validation_databundelcode", "databundelcode").alias("code"),
        "databundelcode",
        dates.display_date("last_updated").alias("updated"),
        dates.display_delivery("leverdatum").alias("delivery"),
        labels.count_report_name("databundelcode").alias("report_name"),
    )


def layer_pick(spark: SparkSession, sf: str) -> DataFrame:
    requests = _overview(spark, sf).select("krmcriterium", "publication_status")
    return status.pick_layers(requests, sv.view(spark, sf, sv.CATALOG))


PACKED = (
    "meetwaarde_lokaalid",
    "monster_lokaalid",
    "meetobject_lokaalid",
    "grootheid_code",
    "typering_code",
    "eenheid_code",
    "bemonsteringsapparaat_omschrijving",
    "parameter_code",
    "biotaxon_naam",
    "begindatum",
    "numeriekewaarde",
    "alfanumeriekewaarde",
    "limietsymbool",
    "kwaliteitsoordeel_code",
    "namespace",
    "referentiehorizontaal_code",
    "analysecompartiment_code",
    "geometriepunt_x",
    "geometriepunt_y",
)


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    return _pack(sv.records(spark, sf))


def _pack(records: DataFrame) -> DataFrame:
    m = records.withColumnsRenamed({"lon": "geometriepunt_x", "lat": "geometriepunt_y"})
    return deliveries.pack_pieces(m, list(PACKED), approved=True)


def bundle_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = deliveries.bundle_records(_packed(spark, sf))
    return rows.select(
        F.substring_index("bundle", "+", 1).alias("bundle"),
        "meetwaarde_lokaalid",
        "typering_code",
        "begindatum",
        F.col("numeriekewaarde").try_cast("double").alias("numeriekewaarde"),
        "limietsymbool",
        "lon",
        "lat",
    )


def bundle_files(spark: SparkSession, sf: str) -> DataFrame:
    info = deliveries.bundle_info(_packed(spark, sf))
    return info.groupBy(F.substring_index("bundle", "+", 1).alias("bundle"), "approved").agg(
        F.sum("n_rows").alias("n_rows"), F.count("error").alias("errors"), F.max(F.size("header")).alias("n_columns")
    )


def stream_status(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    updates = arriving.select(
        F.concat(F.lit("U_"), F.col("user_id").cast("string")).alias("databundelcode"),
        F.concat(F.lit("ANSNL-"), F.col("event_type")).alias("krmcriterium"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
        F.col("event_type").alias("status"),
        F.struct("ts", "event_id").alias("arrival"),
    )
    root = scratch_path(spark, "stream-status")
    ingest.follow_status(updates, "arrival", root).awaitTermination()
    return sinks.read_status_table(spark, root).drop("arrival")


def _counted(failures: DataFrame) -> DataFrame:
    return failures.groupBy("bundle", "section", "uitvalreden").agg(F.count("*").alias("failures"))


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """ZIP files land in a folder, some after the stream was stopped; it goes on from its checkpoint."""
    root = scratch_path(spark, "stream-ingest")
    files = settled(_packed(spark, sf)).table
    late = F.substring("path", 1, 1).cast("int") % 2 == 0
    refs = _ingest_references(spark, sf)
    for part in (files.where(~late), files.where(late)):
        stored.write_files(part, f"{root}/landing")
        arriving = ingest.landing_stream(spark, f"{root}/landing", files_a_batch=2)
        ingest.ingest(arriving, refs, f"{root}/out").awaitTermination()
    return _counted(snapshots.read(spark, f"{root}/out", "failures"))


def redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """All bundles are delivered; then one comes again with other records, one that can't be read, and the job breaks off.

    ``state`` tells what is to be seen: before, after the broken job, and after the job was run again.
    """
    root = scratch_path(spark, "redelivery")
    refs = _ingest_references(spark, sf)
    seen = lambda state: _counted(snapshots.read(spark, root, "failures")).withColumn("state", F.lit(state))
    ingest.process_files(_packed(spark, sf), refs, root, 0)
    states = [settled(seen("delivered")).table]
    odd = sv.records(spark, sf).where("bundle = '1-URGENT' and k2 % 2 = 1")
    unread = spark.createDataFrame([("3-MEDIUM.zip", 0, bytearray(b"no archive"))], "path string, place bigint, piece binary")
    again = settled(_pack(odd).unionByName(unread)).table
    ingest.stage_files(again, refs, root, "s1")  # everything is written, and the job is lost before its commit
    states.append(settled(seen("broken")).table)
    for _ in range(2):  # the repeated batch, and once more
        ingest.process_files(again, refs, root, 1)
    status = sinks.read_status_table(spark, f"{root}/status")
    states.append(seen("repeated"))
    states.append(status.groupBy("status").agg(F.count("*").alias("failures")).select(
        F.lit("all").alias("bundle"), F.lit("status").alias("section"), F.col("status").alias("uitvalreden"), "failures", F.lit("status").alias("state")
    ))
    return reduce(lambda a, b: a.unionByName(b), states)


def _ingest_references(spark: SparkSession, sf: str):
    from tidegate.config import Settings

    refs = sv.references(spark, sf)
    refs.settings = Settings()
    return refs


def stream_publish(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "stream-publish")
    for number, layer in enumerate(_layers(spark, sf)):
        named = layer.toDF(*[c.lower() for c in layer.columns]).withColumn("bundle", F.lit(f"layer {number}"))
        named.write.parquet(f"{root}/geopackages/layer={number}")
    schema = spark.read.option("mergeSchema", "true").parquet(f"{root}/geopackages").drop("layer").schema
    arriving = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/geopackages")
    ingest.publish_stream(arriving, f"{root}/published").awaitTermination()
    return _rounded(sinks.published_rows(spark, f"{root}/published").drop("bundle"))


def stream_republish(spark: SparkSession, sf: str) -> DataFrame:
    """Every bundle is published; one is delivered again, an older delivery of another comes late, and a third is withdrawn."""
    root = scratch_path(spark, "stream-republish")
    m = sv.records(spark, sf).select("bundle", "meetwaarde_lokaalid", "lon", "lat", F.lit(geo.LONLAT).alias("crs"), "k2")
    mark = lambda df, number, gone=False: df.withColumns({"delivered": F.lit(number), "withdrawn": F.lit(gone)}).drop("k2")
    no_rows = {c: F.lit(None).cast(t) for c, t in m.dtypes if c not in ("bundle", "k2")}
    gone = sv.bundle_names(spark, sf).where("bundle = '2-HIGH'").select("bundle", *[c.alias(n) for n, c in no_rows.items()], F.lit(0).alias("k2"))
    steps = [
        mark(m, 2), mark(m.where("bundle = '1-URGENT' and k2 <= 2"), 3), mark(m.where("bundle = '5-LOW' and k2 = 1"), 1), mark(gone, 4, True),
    ]
    for number, step in enumerate(steps):
        step.write.parquet(f"{root}/landing/part-{number}")
        # each run takes up what the ones before have not seen
        arriving = spark.readStream.schema(steps[0].schema).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
        ingest.publish_stream(arriving, f"{root}/published", "delivered").awaitTermination()
    return _rounded(sinks.published_rows(spark, f"{root}/published"))


def _listed(df: DataFrame, path: str, names: dict[str, str], **options: str) -> str:
    """One delimited file of a small table in the suppliers' charset (cp1252), with headers as they spell them."""
    # Spark writes Latin-1; the euro sign has a byte of its own in cp1252
    cells = [F.translate(F.col(c).cast("string"), "€", "\x80").alias(c) for c in df.columns]
    named = df.select(*cells).withColumnsRenamed(names).coalesce(1)
    named.write.csv(path, header=True, encoding="ISO-8859-1", quote='"', escape='"', **options)
    return path


def _parts(df: DataFrame, path: str, names: dict[str, str], **options: str) -> str:
    """A folder of delimited part files of a table that grows; its ``ord`` column keeps the order."""
    df.withColumnsRenamed(names).write.csv(path, header=True, **options)
    return path


def rule_list(spark: SparkSession, sf: str) -> DataFrame:
    """The rule list written as a file with odd headers and read again: numbers follow from the records.

    Each rule has a note of two lines with quotes, a separator and a sign that only the suppliers' charset has.
    """
    spelled = {"databundelcode": " DataBundelCode", "locatiecode": "Locatie.Code ", "aantal": "Aantal", "leverdatum": "extra"}
    note = F.concat(F.lit("€ "), F.coalesce(F.col("aantal").cast("string"), F.lit("geen")), F.lit(';"'), "eenheid_code", F.lit('"\nregel '), "limiet")
    rules = sv.view(spark, sf, sv.RULES_SCALE).orderBy("rule_id").drop("rule_id").withColumn("Toelichting", note)
    read = tables.read_rules(spark, _listed(rules, scratch_path(spark, "rule-list"), spelled, sep=";"))
    columns = ("rule_id", "databundelcode", "grootheid_code", "eenheid_code", "locatiecode", "aantal", "limiet", "leverdatum")
    return normalise_rules(read).select(*columns).join(read.select("rule_id", F.col("Toelichting").alias("note")), "rule_id")


def status_files(spark: SparkSession, sf: str) -> DataFrame:
    """Status, planning and published tables written as files and read again, then the overview of them."""
    stamped = sv.view(spark, sf, sv.STATUS).withColumn("last_updated", _stamp("last_updated"))
    planned = sv.view(spark, sf, sv.PLANNING)
    published = sv.view(spark, sf, sv.PUBLISHED).withColumn("ord", F.monotonically_increasing_id())
    spelled = {"databundelcode": "Databundelcode", "last_updated": "Last Updated"}
    new = lambda name: scratch_path(spark, name)
    found = tables.read_status(spark, _parts(stamped, new("status"), spelled, sep=";"), ";", order="ord")
    plan = tables.read_planning(spark, _parts(planned, new("planning"), {"criteria": " criteria"}, sep=";"), order="ord")
    out = tables.read_published(spark, _parts(published, new("published"), spelled), ",", order="ord")
    over = status.status_overview(status.parse_status(found), status.dedupe_planning(plan), out)
    return over.withColumn("last_updated", _stamp("last_updated")).drop("akkoord_reden")


def location_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Points and areas from one text layer, and the distance of every record to what its location has."""
    places = sv.view(spark, sf, sv.POINTS).select("mpnident", F.format_string("POINT (%s %s)", "lon", "lat").alias("geometry"))
    corner = F.struct("vertex", F.concat_ws(" ", F.col("lon").cast("string"), F.col("lat").cast("string")).alias("xy"))
    rings = sv.view(spark, sf, sv.RINGS).groupBy("mpnident", "ring").agg(F.array_sort(F.collect_list(corner)).alias("v"))
    body = F.concat(F.lit("("), F.array_join("v.xy", ", "), F.lit(")"))
    areas = rings.groupBy("mpnident").agg(F.array_sort(F.collect_list(F.struct("ring", body.alias("b")))).alias("r"))
    shapes = areas.select("mpnident", F.concat(F.lit("POLYGON ("), F.array_join("r.b", ", "), F.lit(")")).alias("geometry"))
    refs = sv.references(spark, sf)
    refs.points, refs.rings = tables.locations_from_wkt(places.unionByName(shapes))
    return _to_layers(spark, sf, refs)


def _wide_rings(spark: SparkSession, sf: str) -> DataFrame:
    """An area of 360 corners with a hole of as many around every location."""
    places = sv.view(spark, sf, sv.POINTS).where("mpnident like 'S%'")
    turn = (F.col("vertex") % 360) * F.lit(3.141592653589793) / 180
    wave = 1 + 0.3 * F.sin(9 * turn)
    rings = places.withColumn("ring", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("vertex", F.explode(F.sequence(F.lit(0), F.lit(360))))
    size = F.when(F.col("ring") == 0, 0.05).otherwise(0.01)
    lon, lat = F.col("lon") + size * wave * F.cos(turn), F.col("lat") + 0.6 * size * wave * F.sin(turn)
    return rings.select("mpnident", F.lit(0).alias("geom"), "ring", "vertex", lon.alias("lon"), lat.alias("lat"), F.lit(True).alias("area"))


def shape_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Every record, each at a place of its own, against the large area of its location."""
    refs = sv.references(spark, sf)
    refs.points, refs.rings = None, _wide_rings(spark, sf)
    moved = {"lon": F.col("lon") + (F.col("k3") % 211) * 0.0007 - 0.07, "lat": F.col("lat") + (F.col("k1") % 199) * 0.0005 - 0.05}
    known = matching.with_rulesets(sv.records(spark, sf).withColumns(moved), refs, sv.bundle_names(spark, sf))
    found = row_checks.with_distances(row_checks.with_locations(known, refs), refs)
    return found.select(*KEYS, F.explode("_metres_more").alias("d")).select(*KEYS, F.round("d", 2).alias("distance"))


def binary_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Points and areas written as binary geometry and read back, then the distances of every record to them.

    Of the points some are multiple; of the areas some are multiple and some collections; byte orders and flags differ.
    """
    number = F.substring("mpnident", 2, 9).cast("int")
    spot = F.array(F.array(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))))
    points = sv.view(spark, sf, sv.POINTS).select(
        "mpnident", F.when(number % 3 == 0, wkb.POINTS).otherwise(wkb.POINT).alias("kind"),
        F.array(F.struct(F.lit(wkb.POINT).alias("kind"), spot.alias("rings"))).alias("parts"),
    )
    corner = F.struct("vertex", F.col("lon").alias("x"), F.col("lat").alias("y"))
    lines = sv.view(spark, sf, sv.RINGS).groupBy("mpnident", "ring").agg(F.array_sort(F.collect_list(corner)).alias("v"))
    ring = F.transform("v", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    areas = lines.groupBy("mpnident").agg(F.array_sort(F.collect_list(F.struct("ring", ring.alias("v")))).alias("r")).select(
        "mpnident", F.element_at(F.lit([wkb.AREA, wkb.AREAS, wkb.COLLECTION]), number % 3 + 1).alias("kind"),
        F.array(F.struct(F.lit(wkb.AREA).alias("kind"), F.col("r.v").alias("rings"))).alias("parts"),
    )
    shapes = points.unionByName(areas).withColumn("g", F.struct("kind", F.when(number % 2 == 0, 4258).alias("srid"), "parts"))
    path = scratch_path(spark, "binary-layers")
    binary = F.when(number % 5 < 2, wkb.packed("g", little=True)).otherwise(wkb.packed("g"))
    shapes.select("mpnident", binary.alias("geometry")).write.parquet(path)
    refs = sv.references(spark, sf)
    refs.points, refs.rings = tables.locations_from_wkb(spark.read.parquet(path))
    return _to_layers(spark, sf, refs)


def _to_layers(spark: SparkSession, sf: str, refs) -> DataFrame:
    known = matching.with_rulesets(sv.records(spark, sf), refs, sv.bundle_names(spark, sf))
    found = row_checks.with_distances(row_checks.with_locations(known, refs), refs)
    return found.where(F.col("_known_location").isNotNull()).select(
        *KEYS, F.round("_metres", 3).alias("to_point"), F.round(F.get("_metres_more", F.lit(0)), 3).alias("to_area")
    )


SYSTEMS = ("EPSG:4326", "EPSG:32631", "EPSG:32732", "EPSG:3857", "EPSG:28992", "urn:ogc:def:crs:EPSG::25832")


def foreign_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Two exported layers in six coordinate systems, the second as binary geometry only, merged into one."""
    m = sv.records(spark, sf).withColumn("crs", F.element_at(F.array(*map(F.lit, SYSTEMS)), (F.col("k3") % len(SYSTEMS) + 1).cast("int")))
    m = m.withColumn("at", projections.placed("crs", "lon", "lat"))
    odd = F.substring("bundle", 1, 1).cast("int") % 2 == 1
    first = m.where(odd).select("meetwaarde_lokaalid", "crs", F.col("at.x").alias("lon"), F.col("at.y").alias("lat"))
    second = m.where(~odd).select("meetwaarde_lokaalid", "crs", wkb.point("at.x", "at.y").alias("geom"))
    merged = publish.merge_layers(first, second).withColumn("xy", wkb.point_xy("geom"))
    places = {"lon": F.coalesce("lon", "xy.x"), "lat": F.coalesce("lat", "xy.y")}
    return _rounded(merged.withColumns(places)).select("meetwaarde_lokaalid", "lon", "lat")


def failure_report(spark: SparkSession, sf: str) -> DataFrame:
    """The failure report as a file and read again."""
    path = scratch_path(spark, "failure-report")
    sinks.write_failures_csv(_all_failures(spark, sf), path)
    read = spark.read.csv(path, header=True, multiLine=False, escape='"')
    return read.toDF(*report.REPORT_COLUMNS).groupBy("section", "databundelcode", "uitvalreden").agg(
        F.count("*").alias("failures"), F.countDistinct("record_id").alias("records")
    )


def code_texts(spark: SparkSession, sf: str) -> DataFrame:
    """List membership, boolean texts and bundle names from event keys, for every order."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    allowed = F.when(F.col("o_orderkey") % 3 != 0, "1-URGENT;3-MEDIUM")
    key = F.concat(F.lit("landing/"), F.replace("o_orderpriority", F.lit(" "), F.lit("+")), F.lit("%2B"), F.col("o_orderkey").cast("string"), F.lit(".zip"))
    return orders.select(
        "o_orderkey",
        text.in_list("o_orderpriority", allowed).alias("listed"),
        text.flag_from_text(F.element_at(F.array(*map(F.lit, ("true", "False", "1", "ja", ""))), (F.col("o_orderkey") % 5 + 1).cast("int"))).alias("flag"),
        text.bundle_from_event_key(key).alias("bundle"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_list": rule_list,
    "status_files": status_files,
    "location_layer": location_layer,
    "shape_distance": shape_distance,
    "binary_layers": binary_layers,
    "foreign_layers": foreign_layers,
    "failure_report": failure_report,
    "code_texts": code_texts,
    "rule_selection": rule_selection,
    "rules_exploded": rules_exploded,
    "rule_match": _rule_match(False),
    "rule_match_scale": _rule_match(True),
    "records_without_rule": _row_check("records_without_rule"),
    "groups_for_rules": groups_for_rules,
    "collection_flag": collection_flag,
    "unknown_location": _row_check("unknown_location"),
    "location_distance": _row_check("location_distance"),
    "polygon_distance": polygon_distance,
    "mandatory_columns": _row_check("mandatory_columns"),
    "value_in_any_rule": _row_check("value_in_any_rule"),
    "count_reconciliation": count_reconciliation,
    "count_reconciliation_samples": count_reconciliation_samples,
    "count_reconciliation_fixed": count_reconciliation_fixed,
    "count_reconciliation_samples_fixed": count_reconciliation_samples_fixed,
    "count_report": count_report,
    "parameter_check": parameter_check,
    "collection_groups": collection_groups,
    "collection_reference": _collections("reference"),
    "collection_intent": _collections("intent"),
    "fixed_values": _row_check(*row_checks.FIXED_VALUE_CHECKS),
    "other_checks": _row_check(*row_checks.OTHER_CHECKS),
    "date_range": _row_check("date_range"),
    "failures_all": failures_all,
    "failures_corrected": failures_corrected,
    "failures_by_section": failures_by_section,
    "bundle_summary": bundle_summary,
    "sample_dense_rank": sample_dense_rank,
    "criteria_fanout": criteria_fanout,
    "export_projection": export_projection,
    "export_gate": export_gate,
    "merge_layers": merge_layers,
    "status_upsert": status_upsert,
    "status_parse": status_parse,
    "planning_dedupe": planning_dedupe,
    "latest_delivery": latest_delivery,
    "status_overview": status_overview,
    "status_filter_search_page": status_filter_search_page,
    "overview_last_page": overview_last_page,
    "status_spellings": status_spellings,
    "failure_intake": failure_intake,
    "count_report_files": count_report_files,
    "published_layers": published_layers,
    "kpis": kpis,
    "filter_options": filter_options,
    "year_options": year_options,
    "issue_details": issue_details,
    "issue_summary": issue_summary,
    "issue_totals": issue_totals,
    "issue_bundles": issue_bundles,
    "next_steps": next_steps,
    "display_dates": display_dates,
    "layer_pick": layer_pick,
    "bundle_scan": bundle_scan,
    "bundle_files": bundle_files,
    "stream_status": stream_status,
    "stream_ingest": stream_ingest,
    "redelivery": redelivery,
    "stream_publish": stream_publish,
    "stream_republish": stream_republish,
}
