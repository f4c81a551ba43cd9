"""Binary geometry, coordinate systems and large shapes."""

import math
import random
import struct

import numpy as np
import pytest
from helpers import records, references
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.functions import geo, projections, wkb
from tidegate.operators import publish, row_checks, shapes
from tidegate.operators.matching import with_rulesets
from tidegate.sources import tables


def made(order, kind, body, srid=None, flags=0):
    head = struct.pack(order + "BI", order == "<", kind | flags | (0x20000000 if srid is not None else 0))
    return head + (struct.pack(order + "I", srid) if srid is not None else b"") + body


def xy(order, *points):
    return b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


def n(order, count):
    return struct.pack(order + "I", count)


def examples(o):
    ring, hole = [(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]
    point, line = made(o, 1, xy(o, (3.5, -52.25))), made(o, 2, n(o, 2) + xy(o, (1, 2), (3, 4)))
    area = made(o, 3, n(o, 2) + n(o, 4) + xy(o, *ring) + n(o, 4) + xy(o, *hole))
    parts = {1: [[(3.5, -52.25)]], 2: [[(1, 2), (3, 4)]], 3: [ring, hole]}
    return [
        (point, 1, [(1, parts[1])]), (line, 2, [(2, parts[2])]), (area, 3, [(3, parts[3])]),
        (made(o, 4, n(o, 2) + point + point), 4, [(1, parts[1])] * 2),
        (made(o, 5, n(o, 1) + line), 5, [(2, parts[2])]),
        (made(o, 6, n(o, 2) + area + area), 6, [(3, parts[3])] * 2),
        (made(o, 7, n(o, 3) + point + line + made(o, 6, n(o, 1) + area)), 7, [(1, parts[1]), (2, parts[2]), (3, parts[3])]),
        (made(o, 1, xy(o, (math.nan, math.nan))), 1, [(1, [])]), (made(o, 2, n(o, 0)), 2, [(2, [[]])]), (made(o, 3, n(o, 0)), 3, [(3, [])]),
        (made(o, 4, n(o, 0)), 4, []),
        (made(o, 1, xy(o, (1, 2, 9)), flags=0x80000000), 1, [(1, [[(1, 2)]])]),
        (made(o, 3001, xy(o, (1, 2, 9, 8))), 1, [(1, [[(1, 2)]])]), (made(o, 2002, n(o, 1) + xy(o, (1, 2, 9))), 2, [(2, [[(1, 2)]])]),
    ]


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("srid", [None, 28992])
def test_all_kinds_are_read_and_written(spark, order, srid):
    cases = examples(order)
    if srid is not None:  # the flag stands in the outermost geometry
        cases = [(c[:1] + struct.pack(order + "I", struct.unpack(order + "I", c[1:5])[0] | 0x20000000) + struct.pack(order + "I", srid) + c[5:], k, p) for c, k, p in cases]
    df = spark.createDataFrame([(i, bytearray(c)) for i, (c, _, _) in enumerate(cases)] + [(99, None)], "i int, w binary").coalesce(1)
    got = {r.i: r.g for r in df.select("i", wkb.parsed("w").alias("g")).collect()}
    assert got.pop(99) is None
    for i, (_, kind, parts) in enumerate(cases):
        found = [(p.kind, [[(v.x, v.y) for v in ring] for ring in p.rings]) for p in got[i].parts]
        assert (got[i].kind, got[i].srid, found) == (kind, srid, [(k, [[tuple(map(float, v)) for v in r] for r in rings]) for k, rings in parts])
    again = df.withColumn("g", wkb.parsed("w")).withColumn("again", wkb.packed("g", little=order == "<"))
    plain = [i for i, (_, _, _) in enumerate(cases) if i not in (6, 11, 12, 13)]  # nested and higher dimensions are written plainly
    for r in again.collect():
        if r.i in plain:
            assert bytes(r.again) == bytes(r.w)
    twice = {r.i: r.g for r in again.where("i < 99").select("i", wkb.parsed("again").alias("g")).collect()}
    assert all(twice[i].parts == got[i].parts for i in got)


@pytest.mark.parametrize("bad", [b"", b"\0", b"\2" + b"\0" * 20, b"\0\0\0\0\x09" + b"\0" * 16, b"\1\2\0\0\0\xff\xff\xff\x7f", b"\1\4\0\0\0\1\0\0\0\1\2\0\0\0\0\0\0\0", b"\0\0\0\0\1" + b"\0" * 17])
def test_what_is_no_geometry_is_an_error(spark, bad):
    with pytest.raises(Exception, match="not well-known binary"):
        spark.createDataFrame([(bytearray(bad),)], "w binary").select(wkb.parsed("w")).collect()


def test_points_are_packed_on_the_jvm(spark):
    points = [(3.25, 52.123456789), (-0.0, 1e-320), (1.7e308, -179.999), (None, 1.0), (math.nan, 1.0)]
    df = spark.createDataFrame(points, "x double, y double").withColumn("w", wkb.point("x", "y"))
    assert "Python" not in df._jdf.queryExecution().toString()
    for r in df.withColumn("p", wkb.point_xy("w")).collect():
        if r.x is None or math.isnan(r.x):
            assert r.w is None and r.p is None or r.p.x is None
        else:
            assert bytes(r.w) == struct.pack(">BIdd", 0, 1, r.x, r.y) and (r.p.x, r.p.y) == (r.x, r.y)


def test_control_points():
    at = lambda code, x, y: tuple(float(v[0]) for v in projections.lonlat(code, np.array([float(x)]), np.array([float(y)])))
    # worked examples of the guidance note: oblique stereographic (on its own datum), spherical Mercator
    x, y = projections.stereographic(np.array([6.0]), np.array([53.0]))
    assert (x[0], y[0]) == pytest.approx((196105.283, 557057.739), abs=0.001)
    assert at(3857, -11169055.58, 2800000.00) == pytest.approx((-(100 + 20 / 60), 24 + 22 / 60 + 54.433 / 3600), abs=1e-7)
    # a control point of the Dutch grid on Texel, within a correction of centimetres
    assert at(28992, 117380.12, 575040.34) == pytest.approx((4.824761912, 53.160753042), abs=2e-6)
    # on the equator and the central meridian of any zone; the southern zones count from 10 000 km
    for code, meridian in ((32601, -177), (32631, 3), (32660, 177), (25832, 9)):
        assert at(code, 500000, 0) == pytest.approx((meridian, 0), abs=1e-12)
    assert at(32731, 500000, 10_000_000) == pytest.approx((3, 0), abs=1e-12)


@settings(max_examples=100, deadline=None)
@given(st.floats(-179, 179), st.floats(-79, 79), st.sampled_from([4326, 3857, 32601, 32631, 32760, 25832, 28992]))
def test_there_and_back(lon, lat, code):
    if (zone := projections.zone(code)) is not None:
        lon = 6 * zone[0] - 183 + lon / 40
    if code == 28992:
        lon, lat = 5 + lon / 100, 52 + lat / 50
    x, y = projections.from_lonlat(code, np.array([lon]), np.array([lat]))
    back = projections.lonlat(code, x, y)
    assert (back[0][0], back[1][0]) == pytest.approx((lon, lat), abs=1e-9)


def test_systems_agree_with_the_columns(spark):
    points = [(3.0, 52.5), (6.2, 53.4), (-1.0, 51.0), (None, 1.0)]
    df = spark.createDataFrame(points, "lon double, lat double").withColumn("crs", F.lit(geo.UTM31))
    east, north = geo.to_utm31("lon", "lat")
    for r in df.select("lon", "lat", east.alias("e"), north.alias("n"), projections.placed("crs", "lon", "lat").alias("p")).collect():
        if r.lon is None:
            assert r.p is None or r.p.x is None
        else:
            assert (r.p.x, r.p.y) == pytest.approx((r.e, r.n), abs=1e-6)
    assert [projections.number(c) for c in ("EPSG:4258", "epsg 3857", "EPSG4258", "urn:ogc:def:crs:EPSG:9.9:28992", "RD", "", None)] == [4258, 3857, 4258, 28992, None, None, None]
    for name in ("EPSG:2154", "local grid", None):
        with pytest.raises(Exception, match="unsupported coordinate system"):
            df.select(projections.degrees(F.lit(name).cast("string"), "lon", "lat")).collect()


def test_layers_of_any_kind_are_moved(spark):
    crs = ["EPSG:28992", "EPSG:4258", "EPSG:32631"]
    ring = [(4.0, 52.0), (4.1, 52.0), (4.1, 52.1), (4.0, 52.0)]
    rows = []
    for name in crs:
        x, y = projections.from_lonlat(projections.number(name), *np.array(ring).T)
        rows.append((name, bytearray(made("<", 6, n("<", 1) + made("<", 3, n("<", 1) + n("<", 4) + xy("<", *zip(x, y)))))))
    merged = publish.merge_layers(spark.createDataFrame(rows, "CRS string, Geom binary")).select(wkb.parsed("geom").alias("g"))
    for r in merged.collect():
        assert r.g.kind == 6 and r.g.srid is None
        assert np.array([(v.x, v.y) for v in r.g.parts[0].rings[0]]) == pytest.approx(np.array(ring), abs=1e-9)


def test_locations_from_binary_and_text_agree(spark):
    texts = [("P", "POINT (3.0 52.0)"), ("M", "MULTIPOINT (1 2, 3 4)"), ("L", "LINESTRING (1 2, 3 4)"), ("A", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))")]
    o = ">"
    cells = {
        "P": made(o, 1, xy(o, (3, 52))), "M": made(o, 4, n(o, 2) + made("<", 1, xy("<", (1, 2))) + made(o, 1, xy(o, (3, 4)))),
        "L": made(o, 2, n(o, 2) + xy(o, (1, 2), (3, 4))), "A": examples(o)[2][0],
    }
    points, rings = tables.locations_from_wkt(spark.createDataFrame(texts, "mpnident string, geometry string"))
    points2, rings2 = tables.locations_from_wkb(spark.createDataFrame([(k, bytearray(v)) for k, v in cells.items()], "mpnident string, geometry binary"))
    rows = lambda df: sorted(tuple(r) for r in df.drop("geom").collect())
    assert rows(points) == rows(points2) and rows(rings) == rows(rings2)


def brute(point, rings, area):
    """Distance of a point to the edges of rings, 0 inside."""
    x, y = point
    best, passed = math.inf, 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] if len(ring) > 1 else ring):
            dx, dy = x2 - x1, y2 - y1
            t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
            best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
            passed += (y1 > y) != (y2 > y) and x < dx * (y - y1) / dy + x1
    return 0.0 if area and passed % 2 else best


@pytest.mark.parametrize("size", [1, 3, 64])
def test_tiles_equal_brute_force(spark, size):
    rng = random.Random(size)
    rows, by = [], {}
    for loc, (corners, area) in {"A": (200, True), "B": (37, True), "L": (90, False), "dot": (1, False)}.items():
        for geom in (0, 1):
            for ring, scale in ((0, 0.05), (1, 0.02)):
                turns = sorted(rng.random() * 2 * math.pi for _ in range(corners))
                radius = [scale * rng.uniform(0.6, 1) for _ in turns]
                ends = [(4 + geom * 0.07 + r * math.cos(t), 52 + r * math.sin(t)) for t, r in zip(turns, radius)]
                ends += ends[:1] if area else []
                rows += [(loc, geom, ring, v, x, y, area) for v, (x, y) in enumerate(ends)]
                by.setdefault((loc, geom), ([], area))[0].append(ends)
    rings = spark.createDataFrame(rows, "mpnident string, geom int, ring int, vertex int, lon double, lat double, area boolean")
    spots = [(loc, 4 + rng.uniform(-0.15, 0.2), 52 + rng.uniform(-0.1, 0.1)) for loc in ("A", "B", "L", "dot", "none") for _ in range(60)]
    spots += [("A", *by["A", 0][0][0][0]), ("A", by["A", 0][0][0][5][0], by["A", 0][0][0][7][1])]  # on a corner, level with a corner
    metres = lambda p: [float(v[0]) for v in projections.from_lonlat(32631, np.array([p[0]]), np.array([p[1]]))]
    east, north = geo.to_utm31("lon", "lat")
    places = spark.createDataFrame(spots, "location string, lon double, lat double").select("location", east.alias("x"), north.alias("y"))
    got = {(r.location, round(r.x, 3), round(r.y, 3), r.geom): r.metres for r in shapes.tile_distances(places, shapes.edge_tiles(rings, size)).collect()}
    want = {}
    for loc, lon, lat in spots:
        for (name, geom), (lines, area) in by.items():
            if name == loc:
                p = metres((lon, lat))
                want[loc, round(p[0], 3), round(p[1], 3), geom] = brute(p, [[metres(v) for v in line] for line in lines], area)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_shapes_in_the_distance_check(spark):
    """Every shape of a location that is too far is a failure of its own; missing coordinates fail nothing."""
    turn = [2 * math.pi * k / 40 for k in range(41)]
    rings = spark.createDataFrame(
        [("L1", 0, 0, v, 3 + 0.01 * math.cos(t), 52 + 0.01 * math.sin(t), True) for v, t in enumerate(turn)]
        + [("L1", 1, 0, v, 3.2 + 0.01 * v, 52.0, False) for v in range(3)] + [("L2", 0, 0, 0, 3.0, 52.0, False), (None, 0, 0, 0, 3.0, 52.0, False)],
        "mpnident string, geom int, ring int, vertex int, lon double, lat double, area boolean",
    )
    at = [(3.0, 52.0), (3.0, 52.0), (3.1, 52.0), (3.1, 52.0), (3.215, 52.0), (None, 52.0), (None, None), (3.1, 52.0)]
    rows = records(spark, *[{"meetobject_lokaalid": f"NL80_L{1 + i % 2}", "lon": lon, "lat": lat} for i, (lon, lat) in enumerate(at)])
    refs = references(spark, [{"locatiecode": "L1;L2"}])
    refs.points, refs.rings = None, rings
    out = row_checks.row_failures(rows, refs, ["location_distance"])
    found = sorted((r.ord[-1], int(r.informatie.split(": ")[2][:-1])) for r in out.collect())
    metres = lambda p: [float(v[0]) for v in projections.from_lonlat(32631, np.array([p[0]]), np.array([p[1]]))]
    lines = {("L1", 0): ([(3 + 0.01 * math.cos(t), 52 + 0.01 * math.sin(t)) for t in turn], True), ("L1", 1): ([(3.2 + 0.01 * v, 52.0) for v in range(3)], False), ("L2", 0): ([(3.0, 52.0)], False)}
    want = []
    for place, (order, spot) in zip([f"L{1 + i % 2}" for i in range(8)], enumerate(at)):
        far = [brute(metres(spot), [[metres(v) for v in line]], area) for (name, _), (line, area) in lines.items() if name == place and None not in spot]
        want += [(order, int(d)) for d in far if d > 100]
    first = min(o for o, _ in found) - min(o for o, _ in want)
    assert [(o - first, d) for o, d in found] == sorted(want) and len(want) > 4
    known = with_rulesets(rows, refs)
    assert row_checks.with_distances(row_checks.with_locations(known, refs), refs).count() == rows.count()


def test_a_large_ring_against_many_records(spark):
    """100,000 corners and 2,000 places: no row holds all edges, and a sample equals brute force."""
    corners = spark.range(100001).select(
        F.lit("A").alias("mpnident"), F.lit(0).alias("geom"), F.lit(0).alias("ring"), F.col("id").alias("vertex"),
        (4 + 0.2 * (1 + 0.2 * F.sin(F.col("id") / 700)) * F.cos(F.col("id") * 2 * math.pi / 100000)).alias("lon"),
        (52 + 0.2 * (1 + 0.2 * F.sin(F.col("id") / 700)) * F.sin(F.col("id") * 2 * math.pi / 100000)).alias("lat"), F.lit(True).alias("area"),
    )
    tiles = shapes.edge_tiles(corners).cache()
    assert tiles.agg(F.max(F.size("edges"))).first()[0] == shapes.TILE and tiles.agg(F.sum(F.size("edges"))).first()[0] == 100000
    rng = random.Random(1)
    spots = [("A", 4 + rng.uniform(-0.3, 0.3), 52 + rng.uniform(-0.3, 0.3)) for _ in range(2000)]
    east, north = geo.to_utm31("lon", "lat")
    places = spark.createDataFrame(spots, "location string, lon double, lat double").select("location", east.alias("x"), north.alias("y"))
    got = shapes.tile_distances(places, tiles).collect()
    assert len(got) == 2000
    edges = np.array([tuple(e) for r in tiles.select("edges").collect() for e in r.edges])
    for r in rng.sample(got, 40):
        x1, y1, x2, y2 = edges.T
        t = np.clip(((r.x - x1) * (x2 - x1) + (r.y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2), 0, 1)
        near = np.hypot(r.x - x1 - t * (x2 - x1), r.y - y1 - t * (y2 - y1)).min()
        with np.errstate(all="ignore"):
            inside = (((y1 > r.y) != (y2 > r.y)) & (r.x < (x2 - x1) * (r.y - y1) / (y2 - y1) + x1)).sum() % 2
        assert r.metres == pytest.approx(0.0 if inside else near, abs=1e-6)


def test_plain_points_are_read_all_at_once(monkeypatch):
    import pyarrow as pa

    nan = float("nan")
    points = [None, (1.5, -2.0), (nan, nan), (nan, 3.0), (0.0, 7.25), None]

    def packed(mark, order):
        return pa.array([None if p is None else struct.pack(order + "BIdd", mark, 1, *p) for p in points], pa.binary())

    for cells in (packed(0, ">"), packed(1, "<"), packed(0, ">")[1:5], packed(1, "<")[2:], packed(0, ">")[:1], packed(0, ">")[:0]):
        with monkeypatch.context() as m:
            m.setattr(wkb, "_plain_points", lambda cells: None)
            want = wkb._point_columns(cells)
        assert str(wkb._point_columns(cells)) == str(want)
    mixed = pa.concat_arrays([packed(0, ">"), packed(1, "<")])
    assert wkb._point_columns(mixed).null_count == 0 and str(wkb._point_columns(mixed)[7]["x"]) == "1.5"
    with pytest.raises(ValueError):
        wkb._point_columns(pa.array([b"\0" * 21]))

    def one_by_one(*_):
        raise AssertionError("a point was read on its own")

    monkeypatch.setattr(wkb, "_read", one_by_one)
    assert len(wkb._point_columns(packed(0, ">"))) == len(points)


def test_places_are_projected_once(spark):
    """No filter works the projection out, no step writes it out at length, and records at one place share its distance."""
    rings = spark.createDataFrame([("L1", 0, 0, v, 3 + 0.01 * (v % 2), 52 + 0.01 * (v // 2), True) for v in range(4)], "mpnident string, geom int, ring int, vertex int, lon double, lat double, area boolean")
    rows = records(spark, *[{"lon": lon, "lat": lat} for lon, lat in ((3.0, 53.0), (3.0, 53.0), (None, 53.0), (3.0, float("nan")), (0.0, 53.0), (-0.0, 53.0))])
    refs = references(spark)
    refs.points, refs.rings = None, rings
    found = row_checks.with_distances(row_checks.with_locations(with_rulesets(rows, refs), refs), refs)
    lines = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not [line for line in lines if "ATANH" in line and "Filter" in line]
    assert max(line.count("ATANH") for line in lines) <= 4
    got = sorted(tuple(map(int, r["_metres_more"])) for r in found.collect())
    assert got[:2] == [(), ()] and len({*got}) == 3 and len(got) == 6
