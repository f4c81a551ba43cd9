import random

from fixtures import SF, documents, smallest_reachable
from pyspark.sql import functions as F

from tidegate.llm import line_dedup as ld
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES


def normal(line: str) -> bytes:
    folded = line.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
    return b" ".join(folded.split())


def brute(rows):
    """(doc, place) of the lines that go, by exact similarity of all pairs."""
    place, sets = [], {}
    for doc, text in sorted((d, t) for d, t in rows if t is not None):
        for i, line in enumerate(text.split("\n")):
            key = normal(line)
            if key:
                place.append((doc, i, key))
                sets[key] = {key[k : k + ld.SHINGLE] for k in range(max(1, len(key) - ld.SHINGLE + 1))}
    names = {key: i for i, key in enumerate(dict.fromkeys(k for _, _, k in place))}
    inverse: dict = {}
    links = []
    for key, own in sets.items():
        near: dict = {}
        for g in own:
            for other in inverse.setdefault(g, []):
                near[other] = near.get(other, 0) + 1
            inverse[g].append(key)
        links += [(names[key], names[o]) for o, n in near.items() if 100 * n >= ld.PERCENT * (len(own) + len(sets[o]) - n)]
    component = smallest_reachable(names.values(), links)
    first, goes = set(), set()
    for doc, i, key in place:
        c = component[names[key]]
        if c in first:
            goes.add((doc, i))
        first.add(c)
    return goes


def edited(rng, line, n):
    chars = list(line)
    for _ in range(n):
        chars[rng.randrange(len(chars))] = rng.choice("abcdefgh ")
    return "".join(chars)


def test_agrees_with_brute_force(spark):
    rng, rows = random.Random(4), []
    base = ["".join(rng.choice("abcdefghij  klm") for _ in range(rng.choice([20, 40, 90, 300]))) for _ in range(40)]
    for doc in range(60):
        lines = []
        for _ in range(rng.randrange(1, 9)):
            line = rng.choice(base)
            lines.append(rng.choice([line, line.upper(), "  " + line.replace("  ", " \t "), edited(rng, line, 1), edited(rng, line, 3), "", "}"]))
        rows.append((doc, "\n".join(lines)))
    want = brute(rows)
    found = ld.deduplicated(documents(spark, rows)).collect()
    got = {(r.doc_id, i) for r in found for i in r.removed}
    # the banding misses 2 % of the pairs at the similarity itself; components rarely hang on one pair
    assert len(got ^ want) <= 0.01 * len(want)
    for r in found:
        text = dict(rows)[r.doc_id].split("\n")
        assert r.n_lines == len(text)
        assert r.text == "\n".join(x for i, x in enumerate(text) if i not in r.removed)


def test_agrees_with_brute_force_on_the_smallest_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {(r.doc_id, i) for r in QUERIES["op6_line_dedup"](spark, SF).collect() for i in r.removed}
    want = brute(rows)
    assert want and len(got ^ want) <= 0.01 * len(want)


def test_odd_rows(spark):
    line, other = "a line that is long enough to be compared", "quite different words stand in this one here"
    rows = [(1, None), (2, ""), (3, f"{line}\n{line}"), (4, f"x\n\n{line.upper()}  \nx"), (None, line), (None, other), (5, other), (5, other), (6, "short\nshort"), (7, f"{line}\r\n")]
    docs = documents(spark, rows).selectExpr("*", "1 as n_lines", "2 as removed", "'n' as node", "'p' as place")
    out = ld.deduplicated(docs)
    assert out.columns == [*[c for c in docs.columns if c not in ("n_lines", "removed")], "n_lines", "removed"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.removed) for r in out.collect()), key=str)
    assert got == sorted([(1, None, 0, []), (2, "", 1, []), (3, line, 2, [1]), (4, "x\n", 4, [2, 3]), (None, "", 1, [0]), (None, "", 1, [0]),
                          (5, other, 1, []), (5, other, 1, []), (6, "short", 2, [1]), (7, "", 2, [0])], key=str)


def test_short_lines_take_part(spark):
    """A header and a footer that 200 documents share stay once, however short; of lines of one shingle only equal ones go."""
    rows = [(i, f"menu\nbody {i * i * 7919} of the text {i * 104729}\nall rights") for i in range(200)]
    rows += [(300, "}\n}\n{"), (301, "中文\n中文"), (302, "abcdefg\nabcdefh"), (303, "a b\nA  B"), (304, "some line 12\nsome line 123")]
    got = {(r.doc_id, i) for r in ld.deduplicated(documents(spark, rows)).collect() for i in r.removed}
    assert got == brute(rows)
    assert {(i, k) for i in range(1, 200) for k in (0, 2)} <= got and {(300, 1), (301, 1), (303, 1), (304, 1)} <= got and (302, 1) not in got


def test_bands_find_similar_lines_and_leave_others():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(3000)]
    near, far = [], []
    while len(near) < 1000:
        line = " ".join(rng.choice(words) for _ in range(rng.choice((2, 3, 4, 6, 8, 10, 15, 25))))
        other = " ".join(edited(rng, line, rng.choice((1, 1, 2, 3))).split())
        a, b = ({x.encode()[k : k + 7] for k in range(max(1, len(x) - 6))} for x in (line, other))
        if len(line) > 8 and len(other) > 8 and 0.75 <= len(a & b) / len(a | b) < 0.8:
            near.append((line, other))
    while len(far) < 4000:
        far.append(tuple(" ".join(rng.choice(words) for _ in range(rng.choice((4, 6, 8, 10)))) for _ in range(2)))
    chosen = ld.band_bins()
    assert all(len(set(b)) == ld.ROWS for b in chosen.tolist())

    def met(pairs):
        low = [ld.min_hashes(*ld.line_shingles(*ld._starts([x.encode() for x in side])), len(pairs)) for side in zip(*pairs)]
        return (low[0][:, chosen] == low[1][:, chosen]).all(2).any(1).mean()

    assert met(near) >= 0.95 and met(far) <= 0.001


def test_empty_table_and_very_long_line(spark):
    empty = documents(spark, [(1, "x")]).where("doc_id < 0")
    assert ld.deduplicated(empty).count() == 0
    long = "".join(chr(97 + i * i % 26) + str(i) for i in range(100_000))
    out = ld.deduplicated(documents(spark, [(1, long), (2, long + "end"), (3, "tail")]))
    assert {r.doc_id: r.n for r in out.select("doc_id", F.size("removed").alias("n")).collect()} == {1: 0, 2: 1, 3: 0}


def test_bitmaps_are_made_once_a_line(spark, monkeypatch):
    """What lists are compared by holds the bitmaps, not the lines, however many lists a line is in."""
    from tidegate.llm import signatures as sg

    seen, close = [], sg._close
    monkeypatch.setattr(sg, "_close", lambda members, *rest: (seen.append(members), close(members, *rest))[1])
    line = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{line} {i}") for i in range(6)]
    got = {(r.doc_id, k) for r in ld.deduplicated(documents(spark, rows)).collect() for k in r.removed}
    assert got == brute(rows) and len(got) == 5
    data = [r.data for r in seen[0].select("data").collect()]
    assert data and all(len(d) == 64 for d in data)  # 512 bits for some 280 shingles


def test_normal_lines_are_those_of_plain_python():
    rng = random.Random(6)
    for _ in range(500):
        texts = ["".join(rng.choice("aB \n\t\rcdé") for _ in range(rng.randrange(rng.choice((1, 6, 40))))) for _ in range(rng.randrange(1, 4))]
        data, start, length, of, place = ld.normal_lines([t.encode() for t in texts])
        whole = data.tobytes()
        got = [(o, p, whole[s : s + n]) for o, p, s, n in zip(of.tolist(), place.tolist(), start.tolist(), length.tolist())]
        assert got == [(o, p, normal(x)) for o, t in enumerate(texts) for p, x in enumerate(t.split("\n")) if normal(x)]


def test_packing_does_not_take_longer_with_more_buckets():
    """Signatures of a run of texts are packed without a step for each bucket, and come back as they went in."""
    import time

    import numpy as np
    from tidegate.llm import signatures as sg

    rng = np.random.default_rng(1)
    nodes, owner = rng.integers(0, 1 << 60, 3000), np.repeat(np.arange(3000), 40)
    sig = rng.integers(0, 1 << 63, len(owner)).astype(np.uint64)
    began = time.process_time()
    (batch,) = sg.packed(nodes, owner, sig, 30_000)
    assert time.process_time() - began < 0.15
    got = []
    for row in batch.to_pylist():
        node = np.repeat(np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["counts"], np.uint32))
        got += [(row["bucket"], n, k) for n, k in zip(node.tolist(), np.frombuffer(row["keys"], np.uint32).tolist())]
    assert sorted(got) == sorted(zip((sig % 30_000).tolist(), nodes[owner].tolist(), (sig >> np.uint64(32)).tolist()))


def test_shingles_of_many_pairs_are_counted_at_once():
    """Pairs are verified together, on the bytes themselves, not by a Python set for each line."""
    rng = random.Random(3)
    xs = ["".join(rng.choice("ab é") for _ in range(rng.randrange(8, 200))).encode() for _ in range(700)]
    ys = [x[: rng.randrange(8, len(x) + 1)] + bytes([rng.randrange(256)]) * rng.randrange(9) for x in xs]
    cut = lambda line: {line[i : i + ld.SHINGLE] for i in range(len(line) - ld.SHINGLE + 1)}
    assert ld.common_shingles(xs, ys).tolist() == [len(cut(x) & cut(y)) for x, y in zip(xs, ys)]
    assert ld.common_shingles([], []).tolist() == []


def test_copies_are_told_by_the_pass_that_makes_the_bands(spark):
    """Lines that come repeatedly, in one batch or in several, short or long, are known without a pass of their own."""
    from tidegate.llm import signatures as sg

    long = "a line that is long enough for bands"
    docs = documents(spark, [(1, f"x\nx\n{long}"), (2, f"once only, and long enough\n{long.upper()}"), (3, "y\n\n"), (4, " Y "), (5, "z")]).repartition(4)
    rows = sg.lists_of(ld._banded(docs, 3), repeated=True).where("list is null").collect()
    start = ld._starts([normal(x) for x in ("x", long, "y")])
    assert sorted(r.node for r in rows) == sorted(ld.names(ld._totals(start[0]), start[1], start[2]).tolist())


def test_lists_of_three_are_compared_with_others(spark):
    """Lists of up to FEW members are compared together; larger ones, and those that a batch cuts, as before."""
    from tidegate.llm import signatures as sg

    words = [f"w{i}" for i in range(60)]
    rows = [(100 * k + i, " ".join([f"k{k}"] + words[k : k + 40] + [f"v{i}"])) for k, n in enumerate((2, 3, 5, 20, sg.FEW + 9)) for i in range(n)]
    got = {(r.doc_id, k) for r in ld.deduplicated(documents(spark, rows)).collect() for k in r.removed}
    assert got == brute(rows)
