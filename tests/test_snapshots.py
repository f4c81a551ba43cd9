"""Keyed tables and snapshots: batches that replace, break off, repeat or come late, and readers meanwhile."""

import random

import pytest
from pyspark.sql import functions as F
from test_deliveries import packed

from helpers import references
from tidegate.sources import files, keyed, sinks, snapshots
from tidegate.streaming import ingest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, pairs):
    return spark.createDataFrame(list(pairs), "k string, v long")


def data_files(spark, folder):
    out = {}
    for name in files.names(spark, folder):
        for bucket in files.names(spark, f"{folder}/{name}"):
            for part in files.names(spark, f"{folder}/{name}/{bucket}"):
                if part.startswith("part-"):
                    out[f"{name}/{bucket}/{part}"] = len(files.read_bytes(spark, f"{folder}/{name}/{bucket}/{part}"))
    return out


def test_a_batch_replaces_its_keys(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "k", 8)
    assert table.read() is None and table.versions() == []
    rng, want = random.Random(2), {}
    for batch in range(5):
        new = {f"k{rng.randrange(40)}": rng.randrange(1000) for _ in range(15)}
        assert table.merge(f"b{batch}", frame(spark, new.items()))
        want |= new
        assert dict(rows(table.read())) == want
    # a batch that comes again changes nothing, whatever it holds
    assert not table.merge("b4", frame(spark, [("k1", -1)])) and dict(rows(table.read())) == want
    assert [n for _, n in table.versions()] == ["b3", "b4"]


def test_what_a_batch_writes_follows_the_batch(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "k", 32)
    table.merge("all", spark.range(20000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))
    whole = sum(data_files(spark, f"{table.root}/data").values())
    before = set(data_files(spark, f"{table.root}/data"))
    table.merge("one", frame(spark, [("7", 0)]))
    new = {f: n for f, n in data_files(spark, f"{table.root}/data").items() if f not in before}
    assert len(new) == 1 and sum(new.values()) < whole / 16
    assert table.read().count() == 20000 and table.read().where("k = '7'").first().v == 0
    table.merge("none", frame(spark, []))
    assert table.read().count() == 20000


def test_a_broken_batch_is_not_seen_and_a_reader_keeps_its_version(spark, tmp_path, monkeypatch):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    table.merge("a", frame(spark, [("x", 1), ("y", 2)]))
    reader = table.read()
    with monkeypatch.context() as m:
        m.setattr(files, "write_at_once", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge("b", frame(spark, [("x", 5)]))
    assert rows(table.read()) == [("x", 1), ("y", 2)]
    assert table.merge("b", frame(spark, [("x", 5)])) and rows(table.read()) == [("x", 5), ("y", 2)]
    assert rows(reader) == [("x", 1), ("y", 2)]  # begun before, finished after the swap
    # another writer that began with the same version comes too late
    known = table.versions()[:-1]
    with monkeypatch.context() as m:
        m.setattr(keyed.KeyedTable, "versions", lambda _: known)
        with pytest.raises(FileExistsError):
            table.merge("c", frame(spark, [("x", 6)]))
    assert rows(table.read()) == [("x", 5), ("y", 2)]


def test_later_rows_win_in_any_order_of_batches(spark, tmp_path):
    rng = random.Random(3)
    updates = [(f"k{rng.randrange(10)}", i) for i in range(60)]
    want = dict(updates)
    rng.shuffle(updates)
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    for batch in range(0, 60, 12):
        table.merge(str(batch), frame(spark, updates[batch : batch + 12]), keyed.later("k", "v"))
    assert dict(rows(table.read())) == want


def layers(spark, *deliveries):
    """(bundle, delivery, ids, withdrawn) as layer rows."""
    out = [(b, i, n, gone) for b, n, ids, gone in deliveries for i in (ids or [None])]
    return spark.createDataFrame(out, "bundle string, id string, delivered int, withdrawn boolean")


def test_published_batches_equal_a_rebuild(spark, tmp_path):
    out = str(tmp_path / "published")
    published = lambda: rows(sinks.published_rows(spark, out).select("bundle", "id"))
    sinks.publish_batch(layers(spark, ("a", 1, ["1", "2"], False), ("b", 1, ["3"], False), ("c", 4, ["9"], False)), out, "s0", "delivered")
    begun = sinks.published_rows(spark, out)
    # a twice in one batch, b withdrawn, an old delivery of c comes late
    again = layers(spark, ("a", 2, ["5"], False), ("a", 3, ["6", "7"], False), ("b", 2, None, True), ("c", 3, ["8"], False))
    assert sinks.publish_batch(again, out, "s1", "delivered")
    assert published() == [("a", "6"), ("a", "7"), ("c", "9")]
    assert not sinks.publish_batch(again, out, "s1", "delivered")
    assert rows(begun.select("bundle", "id")) == [("a", "1"), ("a", "2"), ("b", "3"), ("c", "9")]
    sinks.publish_batch(layers(spark, ("b", 3, ["4"], False)), out, "s2", "delivered")
    assert published() == [("a", "6"), ("a", "7"), ("b", "4"), ("c", "9")]
    snapshots.clear(spark, out, ("rows",))
    assert published() == [("a", "6"), ("a", "7"), ("b", "4"), ("c", "9")]


def test_a_job_lost_before_its_commit_leaves_the_earlier_results(spark, tmp_path):
    root, refs = str(tmp_path / "out"), references(spark, [{"locatiecode": "L1"}])
    delivered = lambda *pairs: spark.createDataFrame([(f"/in/{n}.zip", bytearray(c)) for n, c in pairs], "path string, content binary")
    seen = lambda: {t: rows(snapshots.read(spark, root, t).select("bundle")) for t in ("failures", "summaries", "geopackages")}
    ingest.process_files(delivered(("B1+a", packed({"namespace": "wrong"})), ("B1+b", packed())), refs, root, 0)
    before = seen()
    assert before["geopackages"] == [("B1+b",)] * 2 and ("B1+a",) in before["failures"]
    again = delivered(("B1+a", packed()), ("B1+b", b"?"))
    ingest.stage_files(again, refs, root, "s1")
    assert seen() == before
    ingest.process_files(again, refs, root, 1)
    after = seen()
    assert after["geopackages"] == [("B1+a",)] * 2 and after["summaries"] == [("B1+a",)] and ("B1+b",) not in after["failures"]
    ingest.process_files(again, refs, root, 1)
    assert seen() == after
    status = {r.databundelcode: r.status for r in sinks.read_status_table(spark, f"{root}/status").collect()}
    assert set(status) == {"B1+a", "B1+b"} and "validatie is: True" in status["B1+a"]


def test_a_landing_stream_goes_on_after_a_killed_batch(spark, tmp_path, monkeypatch):
    """The second batch is lost after its results were written; the stream, started again, takes each file once."""
    landing, root = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    for n in range(3):
        (landing / f"B1+{n}.zip").write_bytes(packed({"namespace": "wrong" if n else "NL80"}))
    refs = references(spark, [{"locatiecode": "L1"}])
    start = lambda: ingest.ingest(ingest.landing_stream(spark, str(landing), files_a_batch=1), refs, root)
    commit, calls = snapshots.commit, []

    def failing(*args, **kwargs):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return commit(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", failing)
        with pytest.raises(Exception, match="executor lost"):
            start().awaitTermination()
    assert snapshots.read(spark, root, "summaries").count() == 1
    start().awaitTermination()
    assert sorted(r.bundle for r in snapshots.read(spark, root, "summaries").collect()) == ["B1+0", "B1+1", "B1+2"]
    assert snapshots.read(spark, root, "failures").groupBy("bundle").count().count() == 2
    assert sinks.read_status_table(spark, f"{root}/status").count() == 3
    start().awaitTermination()  # nothing new
    assert snapshots.read(spark, root, "summaries").count() == 3
