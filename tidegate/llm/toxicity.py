"""Classifier chain: categories are predicted one after the other, each with the earlier ones' probabilities.

Every category has a linear (logistic) model over hashed words and word beginnings, plus one input for each
earlier category. For training, these inputs are out-of-fold: the rows are dealt into folds, and
a row's earlier probability comes from a model that has not seen its fold, so a later model meets
in training what it will meet in use. The models of the folds are fitted in parallel tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import mixed, powers, written

BITS = 20
BEGINNINGS = (4, 5, 6)  # bytes
FOLDS = 3
SAMPLE = 2000  # rows a combination of labels that the models are fitted on, at most
THRESHOLD = 0.5
CONTRAST, ROUNDS = 4.0, 300  # standard errors by which a feature's frequency must differ; rounds of descent
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_BYTE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(4000))


def features(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: (first, end, text of each feature, feature). Lower case; each different word counts once."""
    first = 0
    while first < len(texts):
        end, size, parts = first, 0, []
        while end < len(texts) and (end == first or size + len(texts[end]) < 1 << 20):
            parts.append(texts[end].lower().encode("utf-8", "replace") + b" ")
            size += len(parts[-1])
            end += 1
        data = np.frombuffer(b"".join(parts), np.uint8)
        inside = _WORD[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        of = np.searchsorted(np.cumsum([len(p) for p in parts]), starts, side="right")
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[data] * powers(_BASE, len(data)), dtype=np.uint64)))
        back = powers(_INVERSE, len(data))[starts] if len(starts) else np.zeros(0, np.uint64)
        word = mixed((total[ends] - total[starts]) * back)
        order = np.lexsort((word, of))
        keep = np.ones(len(order), bool)
        keep[1:] = (word[order][1:] != word[order][:-1]) | (of[order][1:] != of[order][:-1])
        order = order[keep]
        owners, found = [of[order]], [word[order]]
        for n in BEGINNINGS:
            at = order[ends[order] - starts[order] > n]
            owners.append(of[at])
            found.append(mixed((total[starts[at] + n] - total[starts[at]]) * back[at] + np.uint64(n)))
        owner, feature = np.concatenate(owners), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
        yield first, end, owner, feature
        first = end


def _margins(owner, feature, n: int, w: np.ndarray) -> np.ndarray:
    return np.bincount(owner, w[feature], n) if len(owner) else np.zeros(n)


def telling(owner, feature, y: np.ndarray) -> np.ndarray:
    """Features (a bool each) whose share of texts differs clearly between the two labels."""
    size = 1 << BITS
    pair = np.unique(owner.astype(np.int64) * size + feature)
    found = pair % size
    all_, positive = np.bincount(found, minlength=size), np.bincount(found, y[pair // size], size)
    n1, n0 = y.sum(), len(y) - y.sum()
    share = all_ / len(y)
    gap = positive / n1 - (all_ - positive) / n0
    return (all_ >= 5) & (np.abs(gap) >= CONTRAST * np.sqrt((share * (1 - share) + 1e-9) * (1 / n1 + 1 / n0)))


def fit(owner, feature, extra: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, decay: float = 1e-4):
    """(weights, weights of the extra inputs and the constant) of a logistic model, by adaptive gradients."""
    keep = telling(owner, feature, y)
    places = np.flatnonzero(keep)
    at = keep[feature]
    owner, feature = owner[at], np.searchsorted(places, feature[at])
    w, v = _descend(owner, feature, len(places), extra, y, weight, rounds, decay)
    out = np.zeros(1 << BITS)
    out[places] = w
    return out, v


def _descend(owner, feature, size: int, extra, y, weight, rounds: int, decay: float):
    n = len(y)
    w, v = np.zeros(size), np.zeros(extra.shape[1] + 1)
    gw, gv = np.full(size, 1e-8), np.full(len(v), 1e-8)
    inputs = np.hstack([extra, np.ones((n, 1))])
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(_margins(owner, feature, n, w) + inputs @ v, -30, 30)))
        error = (p - y) * weight
        dw = np.bincount(feature, error[owner], size)[:size] + decay * w
        dv = error @ inputs
        gw += dw * dw
        gv += dv * dv
        w -= 0.1 * dw / np.sqrt(gw)
        v -= 0.1 * dv / np.sqrt(gv)
    return w, v


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_column: str = "doc_id", text: str = "text",
    sample: int = SAMPLE, folds: int = FOLDS,
) -> dict:
    """The chain, from documents that have a text and, in ``labels``, all labels (0 or 1).

    Of each combination of labels about ``sample`` rows are used, picked by a hash of the id and weighted back to
    how frequent the combination is. They are picked before texts are looked at, so what is joined to the
    documents is bounded by ``sample`` and sent to all of them; no text is dealt out. Rows without an id or a
    label are left out; of repeated ids one row counts. No rows, or a category with one value
    only: its probability is constant.
    """
    ys = [F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)]
    names = [f"y{i}" for i in range(len(categories))]
    rows = labels.select(F.col(id_column).cast("long").alias("id"), *ys).dropna().withColumn("place", F.xxhash64("id", F.lit(11)))
    counts = {tuple(r[n] for n in names): r["count"] for r in rows.groupBy(*names).count().collect()}
    if not counts:
        return {"categories": list(categories), "models": []}
    chosen, weight = F.lit(False), F.lit(1.0)
    for combination, n in counts.items():
        own = F.lit(True)
        for name, value in zip(names, combination):
            own = own & (F.col(name) == value)
        rate = min(1.0, sample / n)
        chosen = chosen | (own & (F.pmod("place", F.lit(1 << 40)) < max(1, int(rate * (1 << 40)))))
        weight = F.when(own, F.lit(1 / rate)).otherwise(weight)
    y = F.array(*[F.col(n).cast("double") for n in names])
    picked = rows.where(chosen).select("id", "place", y.alias("y"), weight.alias("weight")).groupBy("id", "place").agg(
        F.max("y").alias("y"), F.max("weight").alias("weight")
    )
    picked = written(picked, "picked")

    def describe(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, end, owner, feature in features(texts):
                cuts = np.searchsorted(np.sort(owner), np.arange(1, end - first))
                order = np.argsort(owner, kind="stable")
                parts = [p.astype(np.int32).tobytes() for p in np.split(feature[order], cuts)]
                rest = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), *rest.columns[1:]], ["x", *batch.schema.names[1:]])

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    sampled = texts.join(F.broadcast(picked), "id").dropDuplicates(["place"]).select("text", "place", "y", "weight")
    sampled = written(sampled.mapInArrow(describe, "x binary, place long, y array<double>, weight double"), "labelled")
    fold = F.pmod(F.shiftright("place", 24), F.lit(folds)).cast("int")
    sampled = sampled.withColumn("fold", fold).withColumn("extra", F.array().cast("array<double>"))

    def learner(c: int):
        def one(group: pa.Table) -> pa.Table:
            order = np.argsort(np.asarray(group.column("place")), kind="stable")
            group = group.take(pa.array(order))
            left_out = group.column("left_out")[0].as_py()
            parts = [np.frombuffer(x, np.int32) for x in group.column("x").to_pylist()]
            target = np.array([v[c] for v in group.column("y").to_pylist()])
            extra = np.array(group.column("extra").to_pylist(), float).reshape(len(parts), c)
            weights, own = np.asarray(group.column("weight")), np.asarray(group.column("fold"))
            use = own != left_out

            def flat(at):
                some = [parts[i] for i in at]
                return np.repeat(np.arange(len(some)), [len(s) for s in some]), np.concatenate([np.zeros(0, np.int32), *some])

            at = np.flatnonzero(use)
            share = float(np.average(target[at], weights=weights[at])) if len(at) else 0.0
            if not len(at) or share in (0.0, 1.0):
                w, v = np.zeros(1 << BITS), np.r_[np.zeros(c), -30.0 if share < 0.5 else 30.0]
            else:
                w, v = fit(*flat(at), extra[at], target[at], weights[at])
            if left_out < 0:
                some = np.flatnonzero(w)
                sparse = np.concatenate([[len(some)], some, w[some], v]).astype(np.float64).tobytes()
                return pa.table({"place": pa.array([0], pa.int64()), "p": pa.array([0.0]), "w": pa.array([sparse], pa.binary())})
            rest = np.flatnonzero(~use)
            p = _sigmoid(_margins(*flat(rest), len(rest), w) + np.hstack([extra[rest], np.ones((len(rest), 1))]) @ v)
            places = np.asarray(group.column("place"))[rest]
            return pa.table({"place": pa.array(places), "p": pa.array(p), "w": pa.array([None] * len(rest), pa.binary())})

        return one

    models = []
    for c in range(len(categories)):
        # fold -1 leaves nothing out: the model that is used; the others only make out-of-fold inputs
        runs = range(-1, folds) if c + 1 < len(categories) else (-1,)
        copies = sampled.withColumn("left_out", F.explode(F.array(*map(F.lit, runs))))
        fitted = written(copies.groupBy("left_out").applyInArrow(learner(c), "place long, p double, w binary"), f"chain-{c}")
        used = fitted.where("w is not null").first()
        if used is None:  # no labelled document has a text
            return {"categories": list(categories), "models": []}
        packed = np.frombuffer(bytes(used.w))
        n = int(packed[0])
        models.append((packed[1 : n + 1].astype(np.int64), packed[n + 1 : 2 * n + 1], packed[2 * n + 1 :]))
        if c + 1 < len(categories):
            out_of_fold = fitted.where("w is null").select("place", "p")
            sampled = sampled.join(out_of_fold, "place").withColumn("extra", F.concat("extra", F.array("p"))).drop("p")
    return {"categories": list(categories), "models": models}


def _dense(places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS)
    out[places] = weights
    return out


def probabilities(texts: list[str | None], model: dict) -> np.ndarray:
    out = np.zeros((len(texts), len(model["categories"])))
    dense = [(_dense(places, weights), v) for places, weights, v in model["models"]]
    if not dense:
        return out
    for first, end, owner, feature in features([t or "" for t in texts]):
        for c, (w, v) in enumerate(dense):
            inputs = np.hstack([out[first:end, :c], np.ones((end - first, 1))])
            out[first:end, c] = _sigmoid(_margins(owner, feature, end - first, w) + inputs @ v)
    return out


def scores(text: Column, model: dict) -> Column:
    """``array<double>``: the probability of each category, in the chain's order.

    Null and wordless texts have no words: their probabilities are those of an empty text. A model
    without training rows gives 0.
    """
    @F.pandas_udf("array<double>")
    def chain(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            p = probabilities([t if isinstance(t, str) else None for t in series], model)
            yield pd.Series(list(p))

    return chain(text)
