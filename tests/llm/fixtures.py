"""Small tables and plain Python counterparts for the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of river stone quiet harbour seven lantern winter green market letter bridge song copper field morning paper garden road".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def documents(spark: SparkSession, rows) -> DataFrame:
    """``(doc_id, text[, lang[, source]])`` rows as a table like ``documents``."""
    full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def smallest_reachable(ids, links) -> dict:
    """Each id's smallest reachable id."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n=5) -> frozenset:
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def similar(a: frozenset, b: frozenset, percent: int = 75) -> bool:
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= percent * (len(a) + len(b) - common)
