"""Benchmark decontamination by templates: a question is also found when its numbers, names or units are changed.

Texts become templates: a number, in digits or words, is replaced by the placeholder of numbers, a unit by that of
units, a name (a capitalised word that does not begin a sentence) by that of names; all other words are lower-
cased and lose their punctuation. Neighbouring placeholders of one kind are one slot, so a name may get longer. Letters of
scripts without blanks are words of their own. Windows of WINDOW template words are joined by hash with those of the
benchmark; an item with fewer is one window. Windows with fewer than ORDINARY ordinary words tell nothing by their
template and are joined by their words instead, as they stand; so number series are found too.

Windows of a document and an item whose diagonals (place in the document less place in the item) are near make one
alignment, so a word more or less does not break it. Slots are checked on it: a slot value of the item must stand for one
value in the document each time it occurs and two values of the item must not become one. An alignment with
consistent slots counts if it holds COVERAGE of the item's windows, or if its windows cover WORDS_COVERED of the
item's words; a document with such an alignment is contaminated.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import bitmap as bm
from tidegate.llm.common import keeps_columns, mixed, released, written

WINDOW = 8  # template words
COVERAGE = 0.5  # share of the item's windows
WORDS_COVERED = 0.75  # share of the item's words
ORDINARY = 3  # words of a window that are no placeholders; a window with fewer is compared as it stands
LETTERS = 12  # characters that a shorter window without enough ordinary words needs
DRIFT = 8  # diagonals of one alignment differ by less; up to half of it always fall together
NUMBER, NAME, UNIT = 1, 2, 3
# Units that follow numbers.
UNITS = frozenset(
    "mm cm dm m km inch inches in ft foot feet yd yard yards mile miles mg g kg t ton tons oz lb lbs pound pounds "
    "ml cl dl l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years hz khz mhz ghz j kj cal kcal w kw mw kwh v mv a ma k c f pa kpa bar mol "
    "percent % $ € £ ¥ usd eur gbp dollar dollars euro euros cent cents kb mb gb tb bit bits byte bytes mph kmh degree degrees °c °f".split()
)
# Numbers in words.
NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion twenty-one".split()
)
# Scripts without blanks between words.
SINGLE = re.compile("([\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff])")
DIGITS = re.compile(r"[-+]?[$€£¥]?\d[\d.,:/]*")
EDGE = "\"'`“”‘’«»()[]{}<>.,;:!?…*_|#&%$~^=+-–—/\\"
ENDS = (".", "!", "?", ":", "…")
KNOWN = 100_000  # tokens whose description a task keeps
_U = np.uint64


def _name(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))


class _Tokens(dict):
    """A number for each token, and what the token is by itself."""

    def __init__(self):
        self.described: list[tuple] = []  # (is a word, a number, may be a unit, capitalised, ends a sentence, value, characters)
        self.columns: list[np.ndarray] = []

    def arrays(self) -> list[np.ndarray]:
        have = len(self.columns[0]) if self.columns else 0
        if len(self.described) > have:
            fresh = [np.array(c, (bool, bool, bool, bool, bool, _U, np.int64)[i]) for i, c in enumerate(zip(*self.described[have:]))]
            self.columns = [np.concatenate(c) for c in zip(self.columns, fresh)] if have else fresh
        return self.columns

    def forget(self) -> None:
        self.clear()
        self.described.clear()
        self.columns = []

    def __missing__(self, raw: str) -> int:
        bare = raw.strip(EDGE) or (raw if raw in UNITS else "")
        low = bare.lower()
        spelled = low in NUMBER_WORDS or ("-" in low and all(w in NUMBER_WORDS or w == "one" for w in low.split("-")))
        digit = spelled or bool(bare) and (bare[0].isdigit() or (bare[0] in "-+" and bare[1:2].isdigit())) and bool(DIGITS.match(bare))
        capital = bool(bare) and bare[0].isupper() and bare[1:] == bare[1:].lower()
        self.described.append((bool(bare), digit, low in UNITS, capital, raw.endswith(ENDS), _name(low), len(low)))
        self[raw] = len(self.described) - 1
        return self[raw]


def templates(texts: list[str], tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind of slot or 0, value, characters) of all words of the texts, and how many each text has.

    Bare punctuation is no word, but may end a sentence. Kinds follow from the token and the one before.
    """
    split = [(t if t.isascii() else SINGLE.sub(r" \1 ", t)).split() for t in texts]
    if len(tokens) > KNOWN:
        tokens.forget()
    found = np.fromiter(map(tokens.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
    of = np.repeat(np.arange(len(texts)), [len(ws) for ws in split])
    if not len(found):
        return np.zeros(0, np.int8), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    word, digit, unit, capital, ends, value, letters = (c[found] for c in tokens.arrays())
    place = np.cumsum(word) - 1
    ended = np.bincount(np.maximum(place[ends], 0), minlength=int(word.sum()) or 1) > 0
    digit, unit, capital, value, letters, of = digit[word], unit[word], capital[word], value[word], letters[word], of[word]
    first = np.r_[True, of[1:] != of[:-1]][: len(of)]
    begins = first | np.r_[False, ended[: len(of)][:-1]][: len(of)]
    after = np.r_[False, digit[:-1]][: len(of)] & ~first
    kinds = np.select([digit, unit & after, capital & ~begins], [NUMBER, UNIT, NAME], 0).astype(np.int8)
    return kinds, value, letters, np.bincount(of, minlength=len(texts))


class Stream:
    """The words of texts one after the other: template word, kind, value, characters, first and end word in the plain text."""

    def __init__(self, words, kinds, values, letters, start, end, counts) -> None:
        self.words, self.kinds, self.values, self.letters, self.start, self.end, self.counts = words, kinds, values, letters, start, end, counts
        self.begin = np.cumsum(counts) - counts
        self.ordinary = np.concatenate(([0], np.cumsum(kinds == 0)))
        self.so_far = np.concatenate(([0], np.cumsum(letters)))


def streams(texts: list[str], tokens: _Tokens) -> tuple[Stream, Stream]:
    """The texts as templates, and as they stand."""
    kinds, values, letters, counts = templates(texts, tokens)
    of = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    plain = Stream(values, kinds, values, letters, at, at + 1, counts)
    head = np.ones(len(kinds), bool)
    head[1:] = (kinds[1:] == 0) | (kinds[1:] != kinds[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(head)
    length = np.diff(np.r_[first, len(kinds)])
    place = np.arange(len(kinds)) - np.repeat(first, length)
    together = np.add.reduceat(mixed(values + place.astype(_U)), first) if len(first) else values
    value = np.where(length > 1, together, values[first])
    kind = kinds[first]
    chars = np.add.reduceat(letters, first) if len(first) else letters
    slots = Stream(np.where(kind > 0, kind.astype(_U), value), kind, value, chars, at[first], at[first] + length, np.bincount(of[first], minlength=len(counts)))
    return slots, plain


def windows(stream: Stream, size: int, template: bool, exactly: int | None = None):
    """(hash, text, place in the stream) of the windows of ``size`` words: of a template those with enough ordinary words, of
    plain words those without. With ``exactly`` only texts of that many words are taken."""
    n = np.where(stream.counts >= size, stream.counts - size + 1, 0)
    if exactly is not None:
        n = np.where(stream.counts == exactly, n, 0)
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + stream.begin[of]
    tells = stream.ordinary[at + size] - stream.ordinary[at] >= ORDINARY
    if not template:
        tells = ~tells & ((size >= WINDOW) | (stream.so_far[at + size] - stream.so_far[at] >= LETTERS))
    of, at = of[tells], at[tells]
    out = np.full(len(at), 2 * size + template, _U)
    for k in range(size):
        out = mixed(out + stream.words[at + k])
    return out.view(np.int64), of, at


_ITEM = "item_id long, hash long, item_at int, item_end int, size int, template boolean, kinds array<int>, item_values array<long>"


def _items(benchmark: DataFrame, size: int) -> DataFrame:
    """Windows of the benchmark with the number of windows and words of their item, ``windows`` and ``words``."""

    def cut(batches):
        tokens = _Tokens()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for stream, template in zip(streams(texts, tokens), (True, False)):
                for own in range(1, size + 1):
                    hashes, of, at = windows(stream, own, template, None if own == size else own)
                    for h, i, w in zip(hashes.tolist(), of.tolist(), at.tolist()):
                        kinds = stream.kinds[w : w + own].tolist() if template else [0] * own
                        rows.append((ids[i], h, int(stream.start[w]), int(stream.end[w + own - 1]), own, template, kinds, stream.values[w : w + own].view(np.int64).tolist()))
            if rows:
                kinds_of = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds_of)], [c.split()[0] for c in _ITEM.split(", ")])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    found = written(rows.distinct().mapInArrow(released(cut), _ITEM), "item-windows")
    sums = found.groupBy(F.col("item_id").alias("of_item")).agg(F.countDistinct("item_at", "template").alias("windows"), F.max("item_end").alias("words"))
    return found.join(sums, F.col("item_id").eqNullSafe(F.col("of_item"))).drop("of_item")


def _hits(docs: DataFrame, id_column: str, held: np.ndarray, sizes: list[tuple[int, bool]]) -> DataFrame:
    """``doc_id, row, hash, doc_at, doc_end, doc_values``: windows of the documents that the bitmap lets through.

    ``row`` tells documents apart whose ids are equal or null: a hash of the text. ``sizes`` are those of
    the benchmark's windows, of templates or not.
    """

    def cut(batches):
        tokens = _Tokens()
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                some = batch.slice(s, 500)
                ids, keys, texts = (some.column(i).to_pylist() for i in range(3))
                slots, plain = streams(texts, tokens)
                rows = []
                for own, template in sizes:
                    stream = slots if template else plain
                    hashes, of, at = windows(stream, own, template)
                    hit = np.flatnonzero(bm.holds(held, hashes))
                    rows += [(ids[of[i]], keys[of[i]], int(hashes[i]), int(stream.start[at[i]]), int(stream.end[at[i] + own - 1]),
                              stream.values[at[i] : at[i] + own].view(np.int64).tolist()) for i in hit]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
                        ["doc_id", "row", "hash", "doc_at", "doc_end", "doc_values"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text").where("text is not null")
    return source.mapInArrow(released(cut), "doc_id long, row long, hash long, doc_at int, doc_end int, doc_values array<long>")


def matches(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", size: int = WINDOW, coverage: float = COVERAGE
) -> DataFrame:
    """``doc_id, row, item_id, windows, matched, consistent, changed, doc_start, doc_end`` per found item of a document.

    The best alignment of each document and item: ``matched`` windows of the item's ``windows``, whether its slots are
    consistent, how many slot values were ``changed``, and the range of document words. Null or
    empty texts and items match nothing, nor do items without a window: of fewer than three ordinary words and fewer
    than LETTERS characters. Rows with equal ids are told apart by their text; equal rows are
    one. Extra columns are ignored. Empty tables give an empty result.
    """
    items = written(_items(benchmark, size), "items")
    held = bm.bitmap(items, "hash")
    # no more than two for each number of words up to that of a window
    sizes = sorted((r["size"], r["template"]) for r in items.select("size", "template").distinct().collect())
    # AQE broadcasts the items' windows if they are small and splits a frequent window's rows if not
    hits = _hits(docs, id_column, held, sizes).join(items, "hash")
    shift = F.col("doc_at") - F.col("item_at")
    # two rows of bands, half a band apart: near diagonals fall together in one of them
    bands = F.array(*[F.struct(F.lit(o).alias("o"), F.floor((shift + F.lit(o * DRIFT // 2)) / DRIFT).alias("b")) for o in (0, 1)])
    slots = F.filter(
        F.arrays_zip("kinds", "item_values", "doc_values"), lambda s: s["kinds"] != 0
    )
    placed = written(hits.select(
        "doc_id", "row", "item_id", "windows", "words", "item_at", "item_end", "template", "doc_at", "doc_end", slots.alias("slots")
    ).distinct(), "hits").withColumn("band", F.explode(bands))
    key = ["doc_id", "row", "item_id", "band"]
    runs = placed.groupBy(*key).agg(
        F.max("windows").alias("windows"), F.max("words").alias("words"), F.countDistinct("item_at", "template").alias("matched"),
        F.min("doc_at").alias("doc_start"), F.max("doc_end").alias("doc_end"),
    )
    covered = placed.select(*key, F.explode(F.sequence("item_at", F.col("item_end") - 1)).alias("w")).distinct().groupBy(*key).agg(F.count("*").alias("covered"))
    # each (value in the item, value in the document) of an alignment once, then how many partners a value has
    pairs = placed.select(*key, F.explode("slots").alias("s")).select(
        *key, F.col("s.item_values").alias("iv"), F.col("s.doc_values").alias("dv")
    ).distinct()
    partners = pairs.groupBy(*key).agg(
        F.count("*").alias("n"), F.countDistinct("iv").alias("ni"), F.countDistinct("dv").alias("nd"),
        F.sum((F.col("iv") != F.col("dv")).cast("int")).alias("changed"),
    )
    same = lambda other: [F.col(f"r.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in key]
    judged = runs.alias("r").join(partners.alias("p"), same("p"), "left").join(covered.alias("c"), same("c")).select(
        "r.*", "covered", F.coalesce((F.col("n") == F.col("ni")) & (F.col("n") == F.col("nd")), F.lit(True)).alias("consistent"),
        F.coalesce("changed", F.lit(0)).alias("changed"),
    )
    enough = (F.col("matched") >= coverage * F.col("windows")) | (F.col("covered") >= WORDS_COVERED * F.col("words"))
    found = judged.where(enough & F.col("consistent"))
    best = F.max(F.struct("matched", (-F.col("changed")).alias("c"), (-F.col("doc_start")).alias("s"), "windows", "changed", "consistent", "doc_start", "doc_end"))
    return found.groupBy("doc_id", "row", "item_id").agg(best.alias("b")).select(
        "doc_id", "row", "item_id", "b.windows", "b.matched", "b.consistent", "b.changed", "b.doc_start", "b.doc_end"
    )


@keeps_columns("_row", "_maybe", "_d", "_r")
def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` without the contaminated ones; rows with a null text stay."""
    found = written(matches(docs, benchmark, id_column).select("doc_id", "row").distinct(), "found")
    return bm.without(docs, found, id_column)
