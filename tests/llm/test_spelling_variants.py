import random
import re
from collections import Counter
from zlib import crc32

import pytest
from fixtures import SF, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.llm import spelling_variants as sv
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(x, y):
    """Whether exactly one letter is inserted, deleted or replaced between two words."""
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    x, y = sorted((x, y), key=len)
    i = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
    return x[i:] == y[i + 1 :] or (len(x) == len(y) and x[i + 1 :] == y[i + 1 :])


def neighbours(words):
    shapes = {}
    for w in words:
        for i in range(len(w)):
            shapes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        shapes.setdefault(w, set()).add(w)
    out = {w: set() for w in words}
    for group in shapes.values():
        for a in group:
            out[a] |= {b for b in group if near(a, b)}
    return out


def brute(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    by = neighbours(words)
    form = {}
    for w in words:
        best = min(by[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(by[w]), words.get(form[w]))
    return out


def rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_whole_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    found = QUERIES["op11_spelling_variants"](spark, SF)
    assert rows(found) == brute(docs) and found.count() == len(brute(docs))


def vocabulary(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(5)


def alike_words(seed, size=300):
    """Words of few letters, so that many are near, and of lengths from 5 on."""
    rng = random.Random(seed)
    return {"".join(rng.choice("abé") for _ in range(rng.choice((5, 6, 6, 7, 8)))): rng.randrange(3, 90) for _ in range(size)}


@pytest.mark.parametrize("large", [sv.LARGE, 5, 1])
def test_near_words(spark, large):
    """Parts as they are and parts cut at the place of the edit give the same pairs, each once."""
    words = alike_words(1) | {"prefix" + c + "tail": 5 for c in "abcdefghij"} | {"prefixtail": 9, "aaaaaa": 4, "aaaaa": 7, "aaaaaaa": 3}
    got = Counter((r.word, r.near, r.near_n) for r in sv.near_words(vocabulary(spark, words), large).collect())
    want = Counter((a, b, words[b]) for a, some in neighbours(words).items() for b in some)
    assert got == want


def test_short_words_can_take_part(spark):
    words = {w: 3 for w in ("a", "b", "ab", "abc", "bc", "c", "xyz")}
    got = {(r.word, r.near) for r in sv.near_words(vocabulary(spark, words), least=1).collect()}
    assert got == {(a, b) for a, some in neighbours(words).items() for b in some}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=6), max_size=25))
def test_acceptor_and_composition(words):
    root = sv.minimal_acceptor(sorted(words))
    assert sorted(sv._both(root, root)) == sorted(words)
    pairs = list(sv.accepted_pairs(root))
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a, some in neighbours(words).items() for b in some}


def test_acceptor_is_minimal():
    states, open_ = {}, [sv.minimal_acceptor(sorted(["tops", "taps", "top", "tap"]))]
    while open_:
        state = open_.pop()
        states[id(state)] = state
        open_ += state.edges.values()
    assert len(states) == 5


def test_roots_follow_chains(spark):
    chain = [("abcdefg", 100), ("abcdef", 50), ("abcde", 25), ("abcdeg", 12), ("bcdeg", 6), ("bcdegx", 3)]
    docs = documents(spark, [(0, " ".join(" ".join([w] * n) for w, n in chain))])
    got = {r.word: r.root for r in sv.variants(docs, one_in=1 << 40).collect()}
    assert got == {w: "abcdefg" for w, _ in chain}


ODD = [
    (1, None), (2, ""), (3, "1234 ... \n"), (4, "Straße straße STRASSE " * 3), (5, "ÀÉÎÕÜ àéîõü " * 4), (6, "naïve×÷naïve " * 3),
    (7, "letters letter lettres " * 5), (7, "letters letter lettres " * 5), (None, "nameless nameles " * 9), (8, "中文words中文 words " * 3),
    (9, "longer " * 30000), (10, "q" * 5000 + " " + "q" * 5000 + " " + "q" * 5000), (11, "q" * 4999 + " " + "q" * 4999 + " " + "q" * 4999),
]


def test_odd_rows(spark, monkeypatch):
    docs = documents(spark, ODD).withColumns({c: F.lit("x") for c in ("word", "n", "id", "band", "part", "form", "root", "best")})
    assert rows(sv.variants(docs)) == brute(ODD)
    text = " ".join(t for _, t in ODD if t)
    whole = [r for part in sv.runs(text.encode()) for r in part]
    monkeypatch.setattr(sv, "PART", 3)
    assert [r for part in sv.runs(text.encode()) for r in part] == whole


def test_empty_tables(spark):
    assert rows(sv.variants(documents(spark, []))) == {}
    assert rows(sv.variants(documents(spark, [(1, None), (2, "few")]))) == {}
