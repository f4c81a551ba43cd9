import itertools
import random

import numpy as np
import pytest
from fixtures import SF, WORDS, documents, prose, shingles, similar, smallest_reachable
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegate.llm import ngram_join, signatures
from tidegate.llm.common import shingle_hashes, table, word_hashes
from tidegate.llm.components import components


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if similar(sets[a], sets[b])]
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(sets, links).items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def variants():
    rng, rows = random.Random(3), []
    for base in range(6):
        words = prose(base, (4, 9, 40, 160, 300, 700)[base]).split()
        for change in (0, 0, 1, 2, 5, 10, 20, 40):
            copy = list(words)
            for _ in range(min(change, len(words) // 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            if change == 5:
                copy = copy[: max(1, len(copy) * 4 // 5)]
            rows.append((len(rows), ("\t " if change == 2 else " ").join(copy)))
    shared = prose(99, 60)  # a passage that unrelated documents share
    rows += [(len(rows) + i, prose(1000 + i, 150) + " " + shared) for i in range(30)]
    return rows


def test_agrees_with_brute_force_over_sizes_and_edits(spark):
    rows = variants()
    assert found(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


def test_agrees_with_brute_force_on_the_smallest_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(ngram_join.near_duplicates(docs)) == brute(rows)


def test_lists_larger_than_a_block_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(signatures, "BLOCK", 7)
    monkeypatch.setattr(signatures, "ROWS", 3)
    rows = variants()
    assert found(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


def test_empty_and_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (5, "one two"), (None, "one two"), (7, long), (8, long + " end")]
    docs = documents(spark, rows).selectExpr("*", "1L as node", "2 as component_id", "'x' as row")
    out = ngram_join.near_duplicates(docs)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.n_copies) for r in out.collect())
    assert got == sorted([("1", 0, 1, 1), ("2", 0, 2, 1), ("3", 0, 3, 1), ("4", 1, 4, 4), ("5", 1, 4, 4), ("5", 1, 4, 4),
                          ("None", 1, 4, 4), ("7", 59996, 7, 1), ("8", 59997, 7, 1)])
    kept = ngram_join.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "7"]


def test_rows_alike_in_all_columns_leave_one_and_equal_ids_do_not_join_texts(spark):
    rows = [(1, prose(1, 30)), (1, prose(1, 30)), (1, prose(2, 30)), (1, None), (1, None)]
    kept = ngram_join.deduplicated(documents(spark, rows)).collect()
    assert sorted(str(r.text)[:8] for r in kept) == sorted([prose(1, 30)[:8], prose(2, 30)[:8], "None", "None"])


def test_empty_table(spark):
    empty = documents(spark, [(1, "x")]).where("doc_id < 0")
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.deduplicated(empty).count() == 0


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_every_similar_pair_shares_a_signature(percent):
    rng = np.random.default_rng(percent)
    for _ in range(150):
        n = int(rng.integers(2, 400))
        a = rng.choice(2**60, n, replace=False).astype(np.uint64)
        drop = int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1))
        b = np.concatenate([a[drop:], rng.choice(2**60, int(rng.integers(0, drop + 1))).astype(np.uint64)])
        common = len(np.intersect1d(a, b))
        if len(b) == 0 or 100 * common < percent * (len(a) + len(b) - common) or set(a) == set(b):
            continue
        sizes = np.array([len(a), len(b)])
        of, hashes = np.repeat([0, 1], sizes), np.concatenate([np.sort(a), np.sort(b)])
        sent = [set(), set()]
        for owner, sig in ngram_join.signatures(of, hashes, sizes, percent):
            for o, s in zip(owner.tolist(), sig.tolist()):
                sent[o].add(s)
        assert sent[0] & sent[1]


def test_parity_never_exceeds_the_symmetric_difference():
    rng = np.random.default_rng(1)
    for _ in range(100):
        universe = rng.choice(2**62, 900, replace=False).astype(np.uint64)
        a, b = (np.sort(rng.choice(universe, int(rng.integers(1, 800)), replace=False)) for _ in range(2))
        if len(a) > len(b):
            a, b = b, a
        bits = signatures.parity(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), np.array([len(a), len(b)]))
        edges, gaps = signatures._distances(np.array([len(a), len(b)]), bits)
        other = (0, slice(1, 2)) if len(edges) == 2 else (1, slice(0, 1))
        assert gaps(0, np.array([0]), *other)[0, 0] <= len(np.setxor1d(a, b))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbß   \t\n\r\x0b\x0c\x1c", max_size=30), min_size=1, max_size=5))
def test_shingle_sets_are_those_of_the_words(texts):
    hashes, of = shingle_hashes(*word_hashes([t.encode() for t in texts]), 5)
    names: dict = {}
    for i, text in enumerate(texts):
        words = text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
        runs = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
        got = hashes[of == i].tolist()
        assert len(got) == len(runs)
        for run, h in zip(runs, got):
            assert names.setdefault(run, h) == h
    assert len(set(names.values())) == len(names)


def test_components_of_chains_stars_and_odd_links(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 299), (299, 300), (None, 5), (400, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
