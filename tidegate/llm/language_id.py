"""Language of a text in two steps: its family, then the language within the family.

Both steps are one-versus-one linear support vector machines over hashed letter n-grams: one machine for
each pair of families, and one for each pair of languages of a family, which only learns what tells
these two apart. Each machine is trained in a task of its own by dual coordinate descent on a
bounded sample (SAMPLE texts a language at most) and its margins are turned into probabilities on a part of
the sample that it was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import give_back, mixed, released

UNDETERMINED = "und"
DIMENSIONS, ORDERS = 4096, 3
SAMPLE = 1000  # texts a language that the machines are trained on, at most
# Families of languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tk tr tt uz",
    "iranian": "fa ku ps tg",
    "indic": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "malayic": "id ms",
}
_FAMILY = {language: family for family, names in FAMILIES.items() for language in names.split()}
_LETTER: list[np.ndarray] = []


def family(language: str) -> str:
    return _FAMILY.get(language.lower().split("-")[0], f"only {language}")


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTER[0]


def _pieces(texts: list[str], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and (size + len(text) > limit or i - first >= 256):
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def features(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: (first text, unit-length feature rows, which of them hold a letter).

    Upper and lower case are alike; whatever is no letter separates words, and words count
    with a blank before and after.
    """
    letter = _letters()
    for first, end in _pieces(texts):
        some = [" " + t.lower() + " " for t in texts[first:end]]
        code = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        of = np.repeat(np.arange(len(some)), [len(t) for t in some])
        isletter = letter[code]
        code = np.where(isletter, code, 32).astype(np.uint64)
        again = np.zeros(len(code), bool)
        again[1:] = ~isletter[1:] & ~isletter[:-1] & (of[1:] == of[:-1])
        code, of, isletter = code[~again], of[~again], isletter[~again]
        rows = np.zeros(len(some) * DIMENSIONS)
        gram = np.zeros(len(code), np.uint64)
        for n in range(1, ORDERS + 1):
            gram = gram[: len(code) - n + 1] * np.uint64(0x110001) + code[n - 1 :]
            inside = of[n - 1 :] == of[: len(code) - n + 1]
            if n == 1:
                inside = inside & isletter
            at = (mixed(gram + np.uint64(n << 58)) >> np.uint64(64 - 12)).astype(np.int64)
            rows += np.bincount(of[n - 1 :][inside] * DIMENSIONS + at[inside], minlength=len(rows))
        rows = np.sqrt(rows).reshape(len(some), DIMENSIONS)
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
        yield first, rows, np.bincount(of, isletter, len(some)) > 0


def support_vector_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one for a constant) of the machine with squared hinge loss, by dual coordinate descent.

    ``x`` may be of any float type: its rows are widened one at a time, so no other copy of it is made.
    """
    alpha, w, rng = np.zeros(len(x)), np.zeros(x.shape[1] + 1), np.random.default_rng(5)
    square, row = np.zeros(len(x)), np.ones(x.shape[1] + 1)
    for i in range(len(x)):
        row[:-1] = x[i]
        square[i] = (row * row).sum() + 0.5 / cost
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(x)):
            row[:-1] = x[i]
            g = y[i] * (w @ row) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - g / square[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * row
                largest = max(largest, abs(new - alpha[i]))
                alpha[i] = new
        if largest < 1e-3:
            break
    return w


def slope(margin: np.ndarray, y: np.ndarray) -> float:
    """By how much a margin is multiplied so that its sigmoid is a probability (likelihood, a few Newton steps)."""
    k = 1.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(k * margin * y, -30, 30)))
        gradient = (margin * y * (1 - p)).sum() - 0.01 * k
        curve = -(margin**2 * p * (1 - p)).sum() - 0.01
        k = float(np.clip(k - gradient / curve, 0.1, 20.0))
    return k


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> dict:
    """The machines, learned from rows with a text that has a letter and a language.

    At most ``sample`` texts of a language are used, those with the smallest hashes; a language
    may have any number of rows. No such row: a model that knows no language. One language: it is
    always the answer.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text), F.lit(3)).alias("place")
    )
    # different texts with a letter: copies fall together before they are counted, as in the sample
    usable = F.when(F.col("text").rlike(r"\p{L}"), F.col("place")).alias("place")
    different = rows.select("lang", usable).distinct().groupBy("lang").agg(F.count("place").alias("n"))
    counts = {r.lang: max(1, r.n) for r in different.collect()}
    if not counts:
        return {"languages": [], "machines": {}}
    wide = F.lit(False)
    for language, n in counts.items():
        # a rate that leaves about one and a half times the sample of different texts, which is then cut exactly
        wide = wide | ((F.col("lang") == language) & (F.pmod("place", F.lit(1 << 40)) < max(1, int(min(1.0, 1.5 * sample / n) * (1 << 40)))))

    def describe(batches):
        for batch in batches:
            langs, texts, places = (batch.column(i).to_pylist() for i in range(3))
            for first, x, some in features(texts):
                at = np.flatnonzero(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[first + i] for i in at], pa.string()), pa.array([places[first + i] for i in at], pa.int64()),
                     pa.array([x[i].astype(np.float16).tobytes() for i in at], pa.binary())], ["lang", "place", "x"],
                )

    from pyspark.sql import Window

    picked = rows.where(wide).groupBy("lang", "place").agg(F.first("text").alias("text")).select("lang", "text", "place")
    described = picked.mapInArrow(released(describe), "lang string, place long, x binary").withColumn(
        "n", F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    ).where(F.col("n") <= sample)
    languages = sorted(counts)
    families = sorted({family(x) for x in languages})
    problems = []  # (name, languages of the one side, of the other)
    for a, b in combinations(families, 2):
        problems.append((f"{a}|{b}", [x for x in languages if family(x) == a], [x for x in languages if family(x) == b]))
    for f in families:
        problems += [(f"{a}|{b}", [a], [b]) for a, b in combinations([x for x in languages if family(x) == f], 2)]
    if not problems:
        return {"languages": languages, "machines": {}}
    sides = described.sparkSession.createDataFrame(
        [(name, x, side) for name, one, two in problems for side, group in ((1, one), (-1, two)) for x in group],
        "problem string, lang string, side int",
    )

    def fit(group: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(group.column("place")), kind="stable")
        column = group.column("x")
        x = np.empty((len(order), DIMENSIONS), np.float16)
        for to, i in enumerate(order.tolist()):
            x[to] = np.frombuffer(column[i].as_buffer(), np.float16)
        y = np.asarray(group.column("side")).astype(float)[order]
        problem = group.column("problem")[0].as_py()
        del group, column
        held = np.arange(len(y)) % 5 == 0
        if len(set(y[~held])) < 2:
            held[:] = False
        at = held if held.any() else ~held
        tried = x[at]
        x, own = x[~held], y[~held]
        w = support_vector_machine(x, own) if len(set(own)) == 2 else np.zeros(x.shape[1] + 1)
        del x
        margin = np.concatenate([tried[s : s + 256].astype(np.float64) @ w[:-1] + w[-1] for s in range(0, len(tried), 256)])
        out = pa.table({"problem": [problem], "w": pa.array([(w * slope(margin, y[at])).tobytes()], pa.binary())})
        give_back()
        return out

    fitted = described.join(F.broadcast(sides), "lang").groupBy("problem").applyInArrow(fit, "problem string, w binary")
    machines = {r.problem: np.frombuffer(bytes(r.w)) for r in fitted.collect()}  # one row a pair
    return {"languages": languages, "machines": machines}


def _chosen(names: list[str], x: np.ndarray, machines: dict) -> tuple[np.ndarray, np.ndarray]:
    """(index of the name, its mean probability against the others) for each row."""
    won = np.zeros((len(x), len(names)))
    for (i, a), (j, b) in combinations(list(enumerate(names)), 2):
        w = machines.get(f"{a}|{b}")
        p = np.full(len(x), 0.5) if w is None else 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        won[:, i] += p
        won[:, j] += 1 - p
    best = won.argmax(1)
    return best, won[np.arange(len(x)), best] / max(1, len(names) - 1) if len(names) > 1 else np.ones(len(x))


def predict(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray]:
    languages, machines = model["languages"], model["machines"]
    families = sorted({family(x) for x in languages})
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    for first, x, some in features([t or "" for t in texts]):
        if not languages:
            break
        which, p = _chosen(families, x, machines)
        for k, f in enumerate(families):
            own = [lang for lang in languages if family(lang) == f]
            at = np.flatnonzero(some & (which == k))
            if len(at):
                best, q = _chosen(own, x[at], machines)
                scores[first + at] = p[at] * q
                for i, b in zip(at, best):
                    names[first + i] = own[b]
    return names, scores


def predicted(text: Column, model: dict) -> Column:
    """``struct<lang, score>`` of a text column.

    Null texts and texts without a letter: ``und`` with score 0, as is every text if the model knows
    no language. Else a learned language and the product of the probabilities of both steps.
    """

    @F.pandas_udf("lang string, score double")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            names, scores = predict([t if isinstance(t, str) else None for t in series], model)
            yield pd.DataFrame({"lang": pd.Series(names, dtype=object), "score": scores})
        give_back()

    return guess(text)
