"""Files in and out: archives, reference lists, layers, status versions, streams."""

import zipfile

import pytest
from helpers import RECORD, records, references
from pyspark.sql import functions as F

from tidegate.functions import geo, wkb
from tidegate.operators import publish, status
from tidegate.sources import bundles, files, sinks, snapshots, tables
from tidegate.streaming import ingest

HEADER = "Meetwaarde.lokaalid;Meetobject.LokaalID ;Monster.lokaalid;Begindatum;Tijd.UTCoffset;GeometriePunt.X;GeometriePunt.Y;Parameter.omschrijving;unknown"


def archive(path, lines=(), header=HEADER, approved=False, name="data.csv"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("readme.txt", "x")
        if approved:
            z.writestr("akkoord.txt", "")
        if header is not None:
            z.writestr(name, "\r\n".join([header, *lines]).encode("cp1252"))
            z.writestr("second.csv", "a;b\r\n1;2")


def test_archives_are_decoded(spark, tmp_path):
    archive(
        tmp_path / "B1+2024.zip",
        ['NL80_1;NL80_L1;NL80_M;23-1-2018;+1;3,5;52;"café; €";z', "", "NL80_2;NA;n/a;x;;;;;"],
        approved=True,
    )
    archive(tmp_path / "short.zip", ["NL80_3;NL80_L2"])
    archive(tmp_path / "empty.zip", [])
    archive(tmp_path / "none.zip", header=None)
    archive(tmp_path / "upper.zip", ["x"], header=None)
    archive(tmp_path / "wide.zip", ["1;2;3;4;5;6;7;8;9;10"])
    (tmp_path / "broken.zip").write_bytes(b"not an archive")
    files = bundles.bundle_files(spark, str(tmp_path))
    rows = {(r["bundle"], r["row_ord"]): r for r in bundles.bundle_records(files).collect()}
    assert set(rows) == {("B1+2024", 0), ("B1+2024", 1), ("short", 0)}
    first, second, short = rows["B1+2024", 0], rows["B1+2024", 1], rows["short", 0]
    assert first["parameter_omschrijving"] == "café; €"
    assert (first["lon"], first["lat"], first["tijd_utcoffset"]) == (3.5, 52.0, "+1")
    assert second["meetobject_lokaalid"] is None and second["monster_lokaalid"] is None and second["lon"] is None
    assert short["meetobject_lokaalid"] == "NL80_L2" and short["begindatum"] is None

    info = {r["bundle"]: r for r in bundles.bundle_info(files).collect()}
    assert info["B1+2024"]["approved"] is True and info["short"]["approved"] is False
    assert info["B1+2024"]["n_rows"] == 2 and "parameter_omschrijving" in info["B1+2024"]["header"]
    no_csv = "No CSV content found in ZIP file"
    assert [info[b]["error"] for b in ("empty", "none", "upper")] == [no_csv] * 3
    assert "line 2" in info["wide"]["error"] and info["broken"]["error"]


def test_a_large_file_is_read_in_pieces(tmp_path):
    import io
    import tracemalloc

    import pyarrow as pa

    rows, line = 1_200_000, b"NL80_1;NL80_L1;NL80_M;23-1-2018;+1;3,5;52;some words of a parameter;and some that nobody knows\r\n"

    def packed(last):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
            z.writestr("data.csv", HEADER.encode() + b"\r\n" + line * rows + last)
        return pa.py_buffer(out.getvalue())

    read = bundles._make_reader("cp1252")
    good, many = packed(b""), packed(b"1;2;3;4;5;6;7;8;9;10\r\n")
    before = pa.default_memory_pool().bytes_allocated()
    tracemalloc.start()
    try:
        _, header, n, error, parts = read("x.zip", good)
        sizes, held = [], 0
        for part in parts():
            sizes.append(part.num_rows)
            held = max(held, pa.default_memory_pool().bytes_allocated() - before)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (n, error, sum(sizes), max(sizes) <= 10000) == (rows, None, rows, True) and "meetwaarde_lokaalid" in header
    assert peak < 48 << 20 and held < 48 << 20  # of 110 MB of text
    assert f"line {rows + 2}" in read("x.zip", many)[3]
    # a byte that the charset lacks, far behind: told as Python tells it for the whole text
    _, header, n, error, parts = read("x.zip", packed(b"\x81"))
    where = len(HEADER) + 2 + rows * len(line)
    assert error == f"'charmap' codec can't decode byte 0x81 in position {where}: character maps to <undefined>"
    assert (header, n, parts) == ([], 0, None)


def test_bundles_are_packed_batch_by_batch_and_land_in_pieces(spark, tmp_path, monkeypatch):
    rows = [(b, f"NL80_{i}", f"{b};{i}") for b, n in (("B1", 95), ("B2", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "bundle string, meetwaarde_lokaalid string, parameter_omschrijving string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        packed = bundles.pack_bundles(df, ["meetwaarde_lokaalid", "parameter_omschrijving"], approved=True).cache()
        packed.count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = {r["path"]: bytes(r["content"]) for r in packed.collect()}
    monkeypatch.setattr(files, "PIECE", 100)
    monkeypatch.setattr(files, "HELD", 300)
    files.write_files(packed, str(tmp_path / "landing"))
    assert {p.name: p.read_bytes() for p in (tmp_path / "landing").glob("*.zip")} == whole
    found = bundles.bundle_files(spark, str(tmp_path / "landing"))
    assert sorted((r["bundle"], r["n_rows"], r["approved"]) for r in bundles.bundle_info(found).collect()) == [("B1", 95, True), ("B2", 3, True)]
    got = bundles.bundle_records(found).select("bundle", "meetwaarde_lokaalid", "parameter_omschrijving")
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_both_spellings_of_a_column(spark, tmp_path):
    archive(tmp_path / "x.zip", ["1;dotted;plain"], header="meetwaarde.lokaalid;tijd.utcoffset;tijd_utcoffset")
    row = bundles.bundle_records(bundles.bundle_files(spark, str(tmp_path))).first()
    assert row["tijd_utcoffset"] == "plain"


def test_reference_lists(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_bytes("Databundelcode;Locatie.code;aantal;criteria\nB1;L1;3;€\n;NA;2.0;x\n".encode("cp1252"))
    got = tables.read_rules(spark, str(path)).orderBy("new_index").collect()
    assert [(r["rule_id"], r["new_index"], r["aantal"]) for r in got] == [(2, 1, 3), (3, 2, 2)]
    assert got[0]["criteria"] == "€" and got[1]["Locatie.code"] is None
    from tidegate.operators.references import normalise_rules

    assert normalise_rules(tables.read_rules(spark, str(path))).where("rule_id = 2").first()["locatiecode"] == "L1"
    comma = tmp_path / "c.csv"
    comma.write_text("col1,col2\n1,a\n2,b\n")
    assert [r["new_index"] for r in tables.read_list(spark, str(comma), ",", "utf-8").collect()] == [1, 2]


def test_status_planning_and_count_report_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Databundelcode; Last  Updated ;status\nB1+x;2024-01-01 00:00:00;Databundel validatie is: True en akkoord file is: False\n\n;;\n")
    parsed = status.parse_status(tables.read_status(spark, str(tmp_path / "s.csv"))).collect()
    assert [(r["databundelcode"], r["validation"], r["approval"]) for r in parsed] == [("B1+x", True, False)]
    (tmp_path / "p.csv").write_text(" databundelcode ;criteria;leverdatum;x\nB1;D1;;9\n")
    assert tables.read_planning(spark, str(tmp_path / "p.csv")).first().asDict() == {"databundelcode": "B1", "criteria": "D1", "leverdatum": "", "ord": 0}
    (tmp_path / "validatielijst_per_locatie_met_aantal_B1 x.csv").write_text("databundelcode,aantaldat,aantalval\nB1 x,3,20.0\n")
    row = tables.read_count_report(spark, str(tmp_path), "B1+x").first()
    assert (row["aantaldat"], row["aantalval"]) == (3, 20)


def test_wkt_layers(spark):
    layer = spark.createDataFrame(
        [("P", "POINT (3.0 52.0)"), ("M", "MULTIPOINT (1 2, 3 4)"), ("L", "LINESTRING (1 2, 3 4)"), ("A", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))")],
        "mpnident string, geometry string",
    )
    points, rings = tables.locations_from_wkt(layer)
    assert sorted((r["mpnident"], r["lon"], r["lat"]) for r in points.collect()) == [("M", 1.0, 2.0), ("M", 3.0, 4.0), ("P", 3.0, 52.0)]
    got = rings.groupBy("mpnident", "ring", "area").count().collect()
    assert sorted(tuple(r) for r in got) == [("A", 0, True, 4), ("A", 1, True, 4), ("L", 0, False, 2)]


def test_status_versions_replace_append_and_repeat(spark, tmp_path):
    root = str(tmp_path / "status")
    schema = "databundelcode string, krmcriterium string, last_updated string, status string"
    put = lambda rows, version=None: sinks.write_status(spark, root, spark.createDataFrame(rows, schema), version)
    put([("a", "c1", "1", "s1"), ("b", "c1", "1", "s1")], 0)
    for _ in range(2):  # a batch that is repeated gives the same table
        put([("a", "c2", "2", "s2"), ("n", "c", "2", "s")], 1)
    got = sorted(tuple(r) for r in sinks.read_status_table(spark, root).collect())
    assert got == [("a", "c2", "2", "s2"), ("b", "c1", "1", "s1"), ("n", "c", "2", "s")]
    assert sinks.status_versions(spark, root) == [0, 1]


def test_upsert_keeps_other_columns_and_updates_every_copy(spark):
    target = spark.createDataFrame(
        [("a", "c", "1", "s", "why"), ("a", "c", "1", "s", None)],
        "databundelcode string, krmcriterium string, last_updated string, status string, akkoord_reden string",
    )
    new = spark.createDataFrame([("a", "d", "2", "t"), ("z", "d", "2", "t")], "databundelcode string, krmcriterium string, last_updated string, status string")
    got = sorted((tuple(r) for r in publish.upsert_status(target, new).collect()), key=str)
    assert got == [("a", "d", "2", "t", "why"), ("a", "d", "2", "t", None), ("z", "d", "2", "t", None)]


def test_failure_csv_keeps_its_header_without_failures(spark, tmp_path):
    from tidegate.plans.validate import run_checks

    none = run_checks(records(spark, {}), references(spark), ["limit_symbol"])
    sinks.write_failures_csv(none, str(tmp_path / "f"))
    text = "".join(p.read_text() for p in (tmp_path / "f").glob("part-*"))
    assert text.strip() == "Section,Databundelcode,Record ID,Uitvalreden,Informatie"


def test_merged_layers_share_one_system(spark):
    a = spark.createDataFrame([("1", 3.0, 52.0, geo.LONLAT, "r")], "Id string, lon double, lat double, crs string, uitvalreden string")
    east, north = geo.to_utm31("lon", "lat")
    b = spark.createDataFrame([("2", 4.0, 53.0)], "id string, lon double, lat double").withColumns({"e": east, "n": north})
    b = b.select("id", wkb.point("e", "n").alias("geom"), F.lit(geo.UTM31).alias("crs"), F.lit("x").alias("extra"))
    merged = publish.merge_layers(a, b)
    read = merged.withColumn("p", wkb.point_xy("geom"))
    rows = {r["id"]: r for r in read.withColumns({"x": F.col("p.x"), "y": F.col("p.y")}).drop("p").collect()}
    assert set(merged.columns) == {"id", "lon", "lat", "geom", "extra"}
    assert abs(rows["2"]["x"] - 4) < 1e-9 and abs(rows["2"]["y"] - 53) < 1e-9 and rows["1"]["lon"] == 3.0


def delivery(folder, name, overrides, approved=False):
    columns = [c for c in RECORD if c not in ("bundle", "row_ord", "lon", "lat")] + ["geometriepunt_x", "geometriepunt_y"]
    row = {**RECORD, "geometriepunt_x": "3.0", "geometriepunt_y": "52.0", **overrides}
    folder.mkdir(exist_ok=True)
    archive(folder / name, [";".join("" if row[c] is None else str(row[c]) for c in columns)], ";".join(columns), approved)


def test_deliveries_are_processed_as_they_land(spark, tmp_path):
    landing, root = tmp_path / "input", str(tmp_path / "out")
    refs = references(spark, [{"locatiecode": "L1"}])
    run = lambda: ingest.ingest(ingest.landing_stream(spark, str(landing)), refs, root).awaitTermination()
    delivery(landing, "B1+first.zip", {})
    delivery(landing, "B1+second.zip", {"namespace": "wrong"})
    delivery(landing, "B1+third.zip", {"namespace": "wrong"}, approved=True)
    (landing / "B1+broken.zip").write_bytes(b"?")
    run()
    exported = lambda: {r["bundle"] for r in snapshots.read(spark, root, "geopackages").collect()}
    assert exported() == {"B1+first", "B1+third"}
    table = {r["databundelcode"]: r["status"] for r in sinks.read_status_table(spark, f"{root}/status").collect()}
    assert table == {
        "B1+first": "Databundel validatie is: True en akkoord file is: False",
        "B1+second": "Databundel validatie is: False en akkoord file is: False",
        "B1+third": "Databundel validatie is: False en akkoord file is: True",
    }
    # the first bundle is delivered again and now fails: its export goes, the others stay
    again = tmp_path / "input2"
    delivery(again, "B1+first.zip", {"namespace": "wrong"})
    summary = ingest.process_files(bundles.bundle_files(spark, str(again)), refs, root, 1)
    assert summary.first()["validation_failures"] == 1
    assert exported() == {"B1+third"}
    assert len(sinks.read_status_table(spark, f"{root}/status").collect()) == 3


def test_columns_a_file_lacks_are_not_reported(spark, tmp_path):
    refs = references(spark, [{"locatiecode": "L1"}])
    refs.columns = spark.createDataFrame([("Orgaan.code", "V"), ("Begindatum", "V")], "kolomnaam string, ihm_verplicht string")
    columns = ["meetwaarde.lokaalid", "meetobject.lokaalid", "begindatum"]
    archive(tmp_path / "B1.zip", ["NL80_1;NL80_L1;"], ";".join(columns))
    files = bundles.bundle_files(spark, str(tmp_path))
    from tidegate.operators import row_checks

    found = row_checks.row_failures(
        bundles.bundle_records(files), refs, ["mandatory_columns", "value_in_any_rule"], bundles.bundle_info(files)
    )
    assert [r["informatie"] for r in found.collect()] == ["geen waarde in bestand voor: begindatum"]


@pytest.mark.parametrize("target", ["test", "production"])
def test_published_layers_come_from_the_target_folder(spark, tmp_path, target):
    folder = {"test": "geopackages", "production": "geopackages_productie"}[target]
    spark.createDataFrame([("1",)], "a string").write.parquet(str(tmp_path / folder / "bundle=x"))
    spark.createDataFrame([("2",)], "b string").write.parquet(str(tmp_path / folder / "bundle=y"))
    merged = publish.merge_layers(tables.read_layers(spark, str(tmp_path), target))
    assert set(merged.columns) == {"a", "b", "bundle"}
    sinks.publish(spark, str(tmp_path), str(tmp_path / "published"), target)
    published = sinks.published_rows(spark, str(tmp_path / "published"))
    assert set(published.columns) == {"a", "b", "bundle"} and published.count() == 2


def test_ordered_part_files_are_read_side_by_side(spark, tmp_path):
    rows = [(f"b{i}+v1", i) for i in range(40)]
    df = spark.createDataFrame(rows, "`Databundelcode` string, ord long")
    df.repartition(4, "ord").write.csv(str(tmp_path / "parts"), header=True, sep=";")
    found = tables.read_status(spark, str(tmp_path / "parts"), ";", order="ord")
    assert len(found.inputFiles()) > 1
    assert sorted((r.databundelcode, r.ord) for r in found.collect()) == sorted(rows)
    plan = tables.read_planning(spark, str(tmp_path / "parts"), order="ord")
    assert plan.columns == ["databundelcode", "criteria", "leverdatum", "ord"] and plan.count() == 40
