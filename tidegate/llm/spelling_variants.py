"""Spelling variants by composing finite-state machines: vocabulary, one edit, vocabulary.

Two words are near if the composition of the vocabulary's acceptor with the transducer of one inserted, deleted
or replaced letter and the acceptor again accepts them. The composition is cut into parts by its initial state:
with a first and a last half of fixed lengths for the length of the shorter word, two near words agree in the one
or in the other, so a part is what the acceptor (or that of the reversed words) accepts after one such half. Each part
is minimised and composed in a task; a part is found by one side only, so every pair comes once.

A half that more than LARGE words share is cut further, at the place of the edit: what remains of a word without the
letter at that place names the part. No more words than there are letters share such a part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import partitions, written

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
ONE_IN = 97  # of the runs of a document, how many lose a letter (the test tables have few variants of their own)
LARGE = 20000
HELD = 200_000  # words that a task counts before it sends them on
PART = 1 << 20  # characters of a text that are searched at once

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")


def runs(text: bytes) -> Iterator[list[str]]:
    """The runs of letters of a text with A-Z folded, in stretches that cover it."""
    folded, at = text.translate(_FOLD).decode("utf-8", "replace"), 0
    while at < len(folded):
        gap = _GAP.search(folded, at + PART)
        end = gap.start() if gap else len(folded)
        yield _RUN.findall(folded, at, end)
        at = end


def altered(doc_id: str, one_in: int):
    """A function that takes a letter out of every ``one_in``-th run of this document, by the hash of id and run."""
    start = crc32(f"{doc_id}:".encode())

    def change(run: str) -> str:
        h = crc32(run.encode(), start)
        if h % one_in:
            return run
        place = h % len(run)
        return run[:place] + run[place + 1 :]

    return change


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """``word, n`` of the words with that many letters and occurrences; null texts have none, a null id is empty text."""
    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text"))

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def count(batches):
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                change = altered(doc_id.as_py(), one_in)
                for found in runs(text.as_py() or b""):
                    for run, n in Counter(found).items():
                        word = change(run)
                        if len(word) >= least_letters:
                            held[word] += n
                    if len(held) > HELD:
                        yield batch_of(held)
                        held.clear()
        yield batch_of(held)

    counted = named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# ---- one part of the composition --------------------------------------------------------


class State:
    """A state of an acceptor: whether a word may end here, and where each letter leads."""

    __slots__ = ("final", "edges")

    def __init__(self) -> None:
        self.final = False
        self.edges: dict[str, State] = {}


def minimal_acceptor(words: list[str]) -> State:
    """The smallest deterministic acceptor of sorted distinct words, built word by word."""
    root, register, last = State(), {}, ""
    path = [root]  # states along the last word

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            known = register.setdefault((state.final, tuple((c, id(s)) for c, s in state.edges.items())), state)
            path[-1].edges[last[len(path) - 1]] = known

    for word in words:
        common = 0
        for a, b in zip(word, last):
            if a != b:
                break
            common += 1
        settle(common)
        for letter in word[common:]:
            state = State()
            path[-1].edges[letter] = state
            path.append(state)
        path[-1].final = True
        last = word
    settle(0)
    return root


def _text(path) -> str:
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def _both(p: State, q: State) -> Iterator[str]:
    """What both states accept: the transducer after its edit copies letters."""
    open_ = [(p, q, None)]
    while open_:
        p, q, path = open_.pop()
        if p.final and q.final:
            yield _text(path)
        for letter in p.edges if p is q else p.edges.keys() & q.edges.keys():
            open_.append((p.edges[letter], q.edges[letter], (path, letter)))


def accepted_pairs(root: State) -> Iterator[tuple[str, str]]:
    """The pairs of words at one edit that the composition accepts from this initial state, each once.

    Before the edit both sides are in the same state; the edit is made at the first place where the words differ.
    """
    open_ = [(root, None)]
    while open_:
        state, path = open_.pop()
        here = None
        letters = list(state.edges.items())
        for i, (a, p) in enumerate(letters):
            for b, q in letters[:i]:  # replaced
                for rest in _both(p, q):
                    here = _text(path) if here is None else here
                    yield here + a + rest, here + b + rest
            for rest in _both(p, state):  # deleted, or inserted seen from the other side
                if not rest.startswith(a):
                    here = _text(path) if here is None else here
                    yield here + a + rest, here + rest
            open_.append((p, (path, a)))


def _composed(band: int, side: str, place: int, paths: list[str], counts: list[int]) -> Iterator[tuple[str, str, int, int]]:
    """Near words ``a, b`` of one part and their counts; ``paths`` are sorted, for side ``s`` reversed words."""
    first = band - band // 2
    cut = place if place >= 0 else first if side == "p" else band - first
    start = paths[0][:cut]
    n = dict(zip(paths, counts))
    for x, y in accepted_pairs(minimal_acceptor([p[cut:] for p in paths])):
        x, y = start + x, start + y
        if min(len(x), len(y)) != band or (place >= 0 and x[place : place + 1] == y[place : place + 1]):
            continue
        a, b = (x[::-1], y[::-1]) if side == "s" and place < 0 else (x, y)
        if side == "p" or a[:first] != b[:first]:
            yield a, b, n[x], n[y]


# ---- all parts --------------------------------------------------------------------------


def _parts(words: DataFrame, large: int, least: int) -> DataFrame:
    """``band, side, place, part, path, n``: every word in the parts of the composition that it can be found in."""
    length = F.length("word")
    bands = F.filter(F.array(length, length - 1), lambda b: b >= least)
    banded = words.select("word", "n", length.alias("length"), F.explode(bands).alias("band"))
    half = F.ceil(F.col("band") / 2).cast("int")
    backwards = F.reverse("word")
    sides = F.array(
        F.struct(F.lit("p").alias("side"), F.substr("word", F.lit(1), half).alias("part"), F.col("word").alias("path")),
        F.struct(F.lit("s").alias("side"), F.substr(backwards, F.lit(1), F.col("band") - half).alias("part"), backwards.alias("path")),
    )
    rows = banded.select("word", "n", "length", "band", F.explode(sides).alias("s")).select(
        "word", "n", "length", "band", half.alias("half"), "s.side", "s.part", "s.path"
    )
    key = ["band", "side", "part"]
    sizes = written(rows.groupBy(*key).agg(F.count("*").alias("members")).where(F.col("members") > 1), "part-sizes")
    sized = rows.join(sizes, key)  # a part of one word has no pair
    usual = sized.where(F.col("members") <= large).select("band", "side", F.lit(-1).alias("place"), "part", "path", "n")

    # parts cut further: without the letter at a place after (p) or in (s) the half, and the shorter word as it is
    from_, to = F.when(F.col("side") == "p", F.col("half")).otherwise(0), F.when(F.col("side") == "p", F.col("band")).otherwise(F.col("half") - 1)
    placed = sized.where(F.col("members") > large).withColumn("place", F.explode(F.sequence(from_, to)))

    def without(word: Column, place: Column) -> Column:
        return F.concat(F.substr(word, F.lit(1), place), F.substr(word, place + 2, F.length(word)))

    shapes = F.array(
        F.when(F.col("place") < F.col("length"), without(F.col("word"), F.col("place"))),
        F.when(F.col("length") == F.col("band"), F.col("word")),
    )
    cut = placed.select("band", "side", "place", F.explode(F.array_compact(shapes)).alias("part"), F.col("word").alias("path"), "n")
    return usual.unionByName(cut)


def near_words(words: DataFrame, large: int = LARGE, least: int = LEAST_LETTERS) -> DataFrame:
    """``word, near, near_n``: all pairs of words at one edit, in both directions, each once.

    ``words`` has ``word, n``, each word once, of ``least`` letters (1 at least) or more.
    """

    def compose(batches):
        key, paths, counts = None, [], []

        def found() -> Iterator[pa.RecordBatch]:
            if len(paths) > 1:
                pairs = list(_composed(*key[:3], paths, counts))
                if pairs:
                    a, b, n, m = zip(*pairs)
                    columns = [pa.array(a + b, pa.string()), pa.array(b + a, pa.string()), pa.array(m + n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i) for i in range(6)]
            names = list(zip(*(c.to_pylist() for c in columns[:4])))
            path, n = columns[4].to_pylist(), columns[5].to_pylist()
            edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for s, e in zip(edges[:-1], edges[1:]):
                if names[s] != key:
                    yield from found()
                    key, paths, counts = names[s], [], []
                paths += path[s:e]
                counts += n[s:e]
        yield from found()

    key = ["band", "side", "place", "part"]
    rows = _parts(words, large, least).select(*key, "path", "n")
    dealt = rows.repartition(partitions(words.sparkSession), *key).sortWithinPartitions(*key, "path")
    return dealt.mapInArrow(compose, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words with a form (``word, form``): the end of their chain, by doubling the steps."""
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = current.join(ahead, "root", "left")
        if not moved.where("further is not null").take(1):
            return current
        current = written(moved.select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(docs: DataFrame, ratio: int = RATIO, large: int = LARGE, **counting: int) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary of ``docs`` (``doc_id, text``).

    A word's form is its near word of the largest n, of equal ones the first in code-point order, if it is ``ratio``
    (2 at least) times as frequent; its root is the end of the chain of forms. Repeated documents count each time; no
    documents, or none with a text, give no rows. Other columns play no part.
    """
    words = written(vocabulary(docs, **counting), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    least = counting.get("least_letters", LEAST_LETTERS)
    near = near_words(words, large, least).groupBy("word").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.less") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    judged = written(judged, "judged")
    ends = _roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
