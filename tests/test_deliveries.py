"""Deliveries that are odd, repeated, or share a clean name."""

import io
import struct
import zipfile

from helpers import RECORD, frame, records, references
from pyspark.sql import functions as F

from tidegate.functions import geo, labels, wkb
from tidegate.operators import row_checks
from tidegate.plans.validate import validate
from tidegate.sources import bundles, sinks, snapshots
from tidegate.streaming import ingest

COLUMNS = [c for c in RECORD if c not in ("bundle", "row_ord", "lon", "lat")]


def packed(*rows, extra=(), approved=False) -> bytes:
    """A delivery with one line for each of the rows."""
    names = [*COLUMNS, "geometriepunt_x", "geometriepunt_y", *extra]
    lines = [";".join(names)]
    for row in rows or ({},):
        whole = {**RECORD, "geometriepunt_x": "3.0", "geometriepunt_y": "52.0", **row}
        lines.append(";".join("" if whole.get(c) is None else str(whole[c]) for c in names))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        if approved:
            z.writestr("akkoord.txt", "")
        z.writestr("data.csv", "\r\n".join(lines).encode("cp1252"))
    return out.getvalue()


def test_one_bad_file_does_not_stop_the_others(spark, tmp_path):
    good = packed()
    (tmp_path / "good.zip").write_bytes(good)
    at = good.index(b"data.csv") + len(b"data.csv")
    (tmp_path / "damaged.zip").write_bytes(good[:at] + bytes(b ^ 0xFF for b in good[at : at + 40]) + good[at + 40 :])
    # flags of the local and the central entry: encrypted; then a method that does not exist
    central = good.index(b"PK\x01\x02")
    flagged = bytearray(good)
    flagged[6] |= 1
    flagged[central + 8] |= 1
    (tmp_path / "encrypted.zip").write_bytes(bytes(flagged))
    method = bytearray(good)
    method[8], method[central + 10] = 77, 77
    (tmp_path / "method.zip").write_bytes(bytes(method))
    huge = io.BytesIO()
    with zipfile.ZipFile(huge, "w") as z:
        z.writestr("data.csv", "meetwaarde.lokaalid;begindatum\r\n" + "x" * 200_000 + ";a\r\nshort")
    (tmp_path / "huge.zip").write_bytes(huge.getvalue())
    files = bundles.bundle_files(spark, str(tmp_path))
    info = {r["bundle"]: r for r in bundles.bundle_info(files).collect()}
    assert {b for b, r in info.items() if r["error"]} == {"damaged", "encrypted", "method"}
    assert {r["bundle"]: r["n"] for r in bundles.bundle_records(files).groupBy("bundle").agg(F.count("*").alias("n")).collect()} == {"good": 1, "huge": 2}


def test_other_delivered_columns_are_kept_and_checked(spark, tmp_path):
    (tmp_path / "B1.zip").write_bytes(packed({"krmcriterium": "ANSNL-X", "monprog.naam": "M", "eigen.kolom": "a"}, {"meetwaarde_lokaalid": "NL80_2"}, extra=("krmcriterium", "monprog.naam", "eigen.kolom")))
    (tmp_path / "B2.zip").write_bytes(packed())
    files = bundles.bundle_files(spark, str(tmp_path))
    rows = {(r["bundle"], r["row_ord"]): r for r in bundles.bundle_records(files).collect()}
    assert (rows["B1", 0]["krmcriterium"], rows["B1", 0]["monprog_naam"]) == ("ANSNL-X", "M")
    assert rows["B1", 0]["extras"]["eigen_kolom"] == "a" and rows["B1", 1]["extras"]["eigen_kolom"] is None
    refs = references(spark)
    refs.columns = spark.createDataFrame([("Eigen.kolom", "V"), ("nergens", "V"), ("Begindatum", "V")], "kolomnaam string, ihm_verplicht string")
    found = row_checks.row_failures(bundles.bundle_records(files), refs, ["mandatory_columns"], bundles.bundle_info(files)).collect()
    assert [(r["bundle"], r["record_id"], r["informatie"]) for r in found] == [("B1", "2", "geen waarde in bestand voor: eigen.kolom")]


def test_many_mandatory_columns_and_several_geometries(spark):
    names = [f"kolom_{i:04d}" for i in range(1100)]
    base = records(spark, *[{"lon": 9.0}] * 8)
    wide = base.select("*", *[F.lit(None).cast("string").alias(n) for n in names])
    refs = references(spark, points=(("L1", 3.0, 52.0), ("L1", 3.1, 52.0)))
    refs.columns = spark.createDataFrame([(n, "V", i) for i, n in enumerate(names)], "kolomnaam string, ihm_verplicht string, col_ord int")
    found = row_checks.row_failures(wide, refs, ["mandatory_columns", "location_distance"])
    counted = {r["section"]: r["n"] for r in found.groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert sorted(counted.values()) == [16, 8800]


def test_names_with_one_clean_name_stay_apart(spark):
    rows = [{"bundle": "B1+x"}, {"bundle": "B1 x", "namespace": "wrong", "meetwaarde_lokaalid": "NL80_b"}]
    refs = references(spark, [{"locatiecode": "L1"}])
    result = validate(records(spark, *rows), refs)
    summary = {r["bundle"]: (r["bundle_valid"], r["validation_failures"]) for r in result.summary.collect()}
    assert summary == {"B1+x": (True, 0), "B1 x": (False, 1)}
    assert {r["bundle"] for r in result.export.collect()} == {"B1+x"}
    assert {(r["bundle"], r["aantaldat"]) for r in result.counts.collect()} == {("B1+x", 1), ("B1 x", 1)}


def test_a_new_delivery_replaces_counts_failures_and_summary(spark, tmp_path):
    root, refs = str(tmp_path / "out"), references(spark, [{"locatiecode": "L1", "aantal": 5}])
    files = lambda *pairs: spark.createDataFrame([(f"/in/{n}.zip", bytearray(c)) for n, c in pairs], "path string, content binary")
    ingest.process_files(files(("B1+a", packed({"namespace": "wrong"})), ("B1+b", packed())), refs, root, 0)
    read = lambda name: snapshots.read(spark, root, name)
    sections = lambda: {(r["bundle"], r["section"]) for r in read("failures").collect()}
    before = sections()
    assert {b for b, _ in before} == {"B1+a", "B1+b"} and len([s for b, s in before if b == "B1+a"]) == 2
    # nothing of the bundle is matched any more: its counts and old failures go
    ingest.process_files(files(("B1+a", packed({"grootheid_code": "other"}))), refs, root, 1)
    assert {r["bundle"] for r in read("counts").collect()} == {"B1+b"}
    assert {b for b, s in sections() & before} == {"B1+b"}
    assert read("summaries").count() == 2
    # and a file that can't be read leaves nothing of the earlier delivery
    ingest.process_files(files(("B1+b", b"?")), refs, root, 2)
    assert {b for b, _ in sections()} == {"B1+a"} and read("summaries").count() == 1


def test_status_follows_the_order_of_updates_over_batches(spark, tmp_path):
    root = str(tmp_path / "status")
    schema = "databundelcode string, krmcriterium string, last_updated string, status string, arrival int"
    for version, rows in enumerate([[("a", "c", "t", "s5", 5), ("b", "c", "t", "s1", 1)], [("a", "c", "t", "s3", 3)], [("b", "c", "t", "s2", 2)], [("n", "c", "t", "s0", 0)]]):
        sinks.write_status(spark, root, spark.createDataFrame(rows, schema), version, "arrival")
    assert {r["databundelcode"]: r["status"] for r in sinks.read_status_table(spark, root).collect()} == {"a": "s5", "b": "s2", "n": "s0"}
    assert sinks.status_versions(spark, root) == [2, 3]


def test_the_published_dataset_is_rebuilt_from_the_current_layers(spark, tmp_path):
    root, out = str(tmp_path), str(tmp_path / "published")

    def deliver(batch, rows, *more):
        snapshots.stage(spark.createDataFrame(rows, "bundle string, id string"), root, "geopackages", batch)
        snapshots.commit(spark, root, spark.createDataFrame([(b,) for b in {r[0] for r in rows} | set(more)], "bundle string"), batch)

    ids = lambda: sorted(r["id"] for r in sinks.published_rows(spark, out).collect())
    deliver("a", [("x", "1"), ("x", "2"), ("y", "3")])
    sinks.publish(spark, root, out)
    assert ids() == ["1", "2", "3"]
    deliver("b", [("x", "4")], "y")  # y is delivered again with nothing to export
    sinks.publish(spark, root, out)
    assert ids() == ["4"]
    snapshots.withdraw(spark, root, spark.createDataFrame([("x",)], "bundle string"), "c")
    sinks.publish(spark, root, out)
    assert ids() == []


def test_points_of_either_byte_order(spark):
    forms = [struct.pack(">BIdd", 0, 1, 3.25, -52.5), struct.pack("<BIdd", 1, 1, 3.25, -52.5), struct.pack("<BIIdd", 1, 0x20000001, 4258, 3.25, -52.5), None]
    df = spark.createDataFrame([(None if f is None else bytearray(f),) for f in forms], "w binary")
    got = [r[0] and tuple(r[0]) for r in df.select(wkb.point_xy("w")).collect()]
    assert got[:3] == [(3.25, -52.5)] * 3 and got[3] in (None, (None, None))


def test_rule_records_are_read_as_they_are(spark):
    texts = ['{"a": "nanoplankton", "b": "l\'eau"}', "{'a': 'x', 'b': nan}", "no record"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(labels.rule_record("t")).collect()] == [{"a": "nanoplankton", "b": "l'eau"}, {"a": "x", "b": None}, None]


def test_missing_reference_tables_are_named(spark):
    import pytest

    refs = references(spark)
    refs.columns = refs.groups = refs.points = None
    for check, word in (("mandatory_columns", "column definition"), ("records_without_rule", "group list"), ("unknown_location", "points")):
        with pytest.raises(ValueError, match=word):
            row_checks.row_failures(records(spark, {}), refs, [check])


def test_look_up_tables_are_computed_once_and_follow_changed_files(spark, tmp_path):
    from tidegate.operators.references import References

    path = str(tmp_path / "groups")
    write = lambda value: spark.createDataFrame([("metalen", value)], "groep string, parameter string").coalesce(1).write.mode("overwrite").parquet(path)
    write("CU")
    rules = references(spark).rules
    make = lambda: References(rules=rules, groups=spark.read.parquet(path))
    refs = make()
    one = refs.side("memberships", lambda: refs.memberships)
    again = make()
    assert again.side("memberships", lambda: again.memberships) is one
    refs.refresh()
    write("ZN")
    changed = make()
    changed._state = refs._state
    changed.refresh()
    assert [r["_member"] for r in changed.side("memberships", lambda: changed.memberships).collect()] == ["zn"]
    assert frame(spark, RECORD, [{}]).count() == 1


def test_a_bundle_is_packed_and_read_by_many_tasks(spark, monkeypatch):
    """No task makes or parses a whole file: its blocks are deflated where the records are, its text is read in runs of lines."""
    monkeypatch.setattr(bundles, "PACKED", 2000)
    monkeypatch.setattr(bundles, "RUN", 3000)
    names = ["meetwaarde_lokaalid", "parameter_omschrijving", "eigen"]
    texts = ["a;b", 'say "so"', "two\r\nlines", '";\n"', None, "€ é", "plain"]
    rows = [(f"B{i % 2}", f"NL80_{i}", texts[i % 7], str(i)) for i in range(2000)] + [(None, "NL80_x", "x", "y")]
    df = spark.createDataFrame(rows, "bundle string, meetwaarde_lokaalid string, parameter_omschrijving string, eigen string").repartition(5)
    pieces = bundles.pack_pieces(df, names, approved=True).cache()
    assert {r["path"] for r in pieces.collect()} == {"B0.zip", "B1.zip", "None.zip"}
    for path in ("B0.zip", "B1.zip"):
        found = sorted((r["place"], bytes(r["piece"])) for r in pieces.where(F.col("path") == path).collect())
        assert len(found) > 8  # around the blocks of five tasks stand the marker, the header, the end and the directory
        with zipfile.ZipFile(io.BytesIO(b"".join(p for _, p in found))) as z:
            assert z.testzip() is None and z.namelist() == ["akkoord.txt", "data.csv"]
    contents = bundles.bundle_contents(pieces)
    got = bundles.records_of(contents).select(F.col("bundle"), *names[:2], F.col("extras")["eigen"], "row_ord").collect()
    assert {tuple(r)[:4] for r in got} == {(r[0] or "None", *r[1:]) for r in rows} and len(got) == len(rows)  # a missing bundle is a file named None
    for bundle in ("B0", "B1"):
        assert sorted(r["row_ord"] for r in got if r["bundle"] == bundle) == list(range(1000))
    info = {r["bundle"]: (r["n_rows"], r["approved"], r["error"], len(r["header"])) for r in bundles.bundle_info(pieces).collect()}
    assert info == {"B0": (1000, True, None, 3), "B1": (1000, True, None, 3), "None": (1, True, None, 3)}
    runs = bundles._files(pieces).mapInArrow(bundles._look("cp1252", True), bundles.RUNS).groupBy("path").count().collect()
    assert {r["path"]: r["count"] > 8 for r in runs} == {"B0.zip": True, "B1.zip": True, "None.zip": False}, runs


def test_runs_of_lines_hold_what_the_whole_file_holds(monkeypatch):
    """Texts with quotes, blank lines and line ends of all kinds: cut, or left to the reader, never cut wrongly."""
    import random

    import pyarrow as pa

    monkeypatch.setattr(bundles, "RUN", 40)
    read, cut, parse = bundles._make_reader("cp1252"), bundles._make_cutter("cp1252"), bundles._parsing()
    rng, seen = random.Random(3), {True: 0, False: 0}
    cells = ["a", "", "NA", '"q;r"', '"two\nlines"', '"he said ""so"""', 'x"y', '"a"b', '"end\r\n"', "\xe9", "long " * 9]
    for case in range(400):
        some = rng.sample(cells, 4) if case % 2 else [c for c in cells if c not in ('x"y', '"a"b')]
        lines = [";".join(rng.choice(some) for _ in range(3 if case % 5 else rng.choice((2, 3, 3, 3)))) for _ in range(rng.randrange(1, 30))]
        end = rng.choice(["\n", "\r\n", "\r"])
        text = ("one;two;three" + end + end.join(line + (end if rng.random() < 0.1 else "") for line in lines)).encode("cp1252")
        whole = pa.py_buffer(text)
        _, header, n, error, parts = read("x.csv", whole)
        runs = []
        found = cut("x.csv", whole, runs.append)
        seen[found is not None] += 1
        if found is None:
            continue
        assert (found[1], sum(found[2]), error) == (header, n, None)
        rows = [r for run, k in zip(runs, found[2]) if k for r in [tuple(x.values()) for x in parse(run, header).to_pylist()][-k:]]
        assert rows == [tuple(x.values()) for part in parts() for x in part.to_pylist()]
    assert seen[True] > 50 and seen[False] > 50


def test_a_large_line_and_pieces_that_are_no_archive(spark, monkeypatch):
    monkeypatch.setattr(bundles, "RUN", 100)
    monkeypatch.setattr(bundles, "RUN_MOST", 300)
    text = packed({"alfanumeriekewaarde": "x" * 5000}, {"meetwaarde_lokaalid": "NL80_2"})
    cut = [("/in/B1.zip", i, bytearray(text[at : at + 7])) for i, at in enumerate(range(0, len(text), 7))]
    files = spark.createDataFrame([*cut, ("/in/B2.zip", 0, bytearray(b"no archive"))], "path string, place bigint, piece binary").repartition(4)
    rows = bundles.bundle_records(files).orderBy("row_ord").collect()
    assert [(r["bundle"], r["row_ord"], len(r["alfanumeriekewaarde"] or "")) for r in rows] == [("B1", 0, 5000), ("B1", 1, 0)]
    assert {r["bundle"]: r["error"] for r in bundles.bundle_info(files).collect()} == {"B1": None, "B2": "File is not a zip file"}


def test_failures_of_deliveries_are_exploded_in_generated_code(spark):
    """Conditions are made once, in a projection; exploding takes a plain column."""
    files = spark.createDataFrame([("/in/B1.zip", bytearray(packed()))], "path string, content binary")
    refs = references(spark, [{"locatiecode": "L1"}], points=(("L1", 3.0, 52.0), ("L1", 3.1, 52.0)))
    found = row_checks.row_failures(bundles.bundle_records(files), refs, bundles=bundles.bundle_info(files))
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "Generate explode(_hits" in plan and "Filter (size(" not in plan


def test_count_lines_of_a_batch_are_made_once(spark, tmp_path, monkeypatch):
    from tidegate.operators import counts

    made, whole = [], counts.count_lines
    monkeypatch.setattr(counts, "count_lines", lambda *a, **b: made.append(1) or whole(*a, **b))
    root, refs = str(tmp_path / "out"), references(spark, [{"locatiecode": "L1", "aantal": 5}])
    ingest.process_files(spark.createDataFrame([("/in/B1+a.zip", bytearray(packed()))], "path string, content binary"), refs, root, 0)
    assert made == [1]
    assert [(r["bundle"], r["aantaldat"], r["aantalval"]) for r in snapshots.read(spark, root, "counts").collect()] == [("B1+a", 1, 5)]
    assert snapshots.read(spark, root, "lines").count() == 1
