import numpy as np
from fixtures import smallest_reachable

from tidegate.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(np.float32(v), float)
            good[i] = a / np.linalg.norm(a)
    links = [(a, b) for a in good for b in good if a > b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= cosine]
    degree = {i: sum(i in link for link in links) for i, _ in rows}
    component = smallest_reachable([i for i, _ in rows], links)
    return {i: (degree[i], component[i], component[i] == i) for i, _ in rows}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def near(rng, v, cosine):
    w = rng.standard_normal(len(v))
    w -= (w @ v) * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def test_agrees_with_brute_force(spark):
    rng, rows = np.random.default_rng(0), []
    for group in range(40):
        base = rng.standard_normal(64)
        rows.append(base)
        rows += [near(rng, base, c) for c in ((0.99, 0.97, 0.96) if group < 12 else (0.93, 0.8))]
    clique = rng.standard_normal(64)
    rows += [near(rng, clique, 0.98) for _ in range(120)]  # a large group of near copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    want, got = brute(rows), found(ed.near_duplicates(df))
    # links are found with high probability, and none below the cosine
    assert sum(got[i][0] for i in got) >= 0.99 * sum(want[i][0] for i in want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert {i: g[1:] for i, g in got.items()} == {i: w[1:] for i, w in want.items()}


def test_odd_vectors_copies_and_widths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, []), (10, [1.0, 2.0, 0.0]), (11, [-1.0, -2.0]), (12, [0.0, -0.0, 5.0]), (13, [0.0, 0.0, 5.0]), (14, [3e38, 3e38]), (15, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA).selectExpr("*", "1 as node", "'k' as kept", "0 as n_links")
    got = found(ed.near_duplicates(df))
    assert got == brute(rows)
    again = ed.near_duplicates(df.union(df.where("vec_id in (1, 4)"))).collect()
    assert sorted((r.n_links, r.n_copies) for r in again if r.vec_id in (1, 4)) == [(0, 1), (0, 1), (5, 3), (5, 3)]


def test_empty_table(spark):
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_calibrated_count_reaches_its_recall():
    count = ed.calibrated(64, ed.BASE, ed.KEPT, 0.9, 0.99, sample=1024)
    rng, lines, reach = np.random.default_rng(77), ed.directions(64, ed.BASE), ed.half_width(0.9)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([near(rng, v, 0.9) for v in a])
    (da, va), (db, vb) = ed.outermost(a, lines, ed.KEPT), ed.outermost(b, lines, ed.KEPT)
    hits = ((da[:, :, None] == db[:, None, :]) & (np.abs(va[:, :, None] - vb[:, None, :]) <= reach)).sum((1, 2))
    assert (hits >= count).mean() >= 0.97
