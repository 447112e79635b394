"""Quality classifier: Naive Bayes support vectors.

A document is the set of its n-grams: words (lower case) and their pairs, and one to three successive
word shapes. A shape keeps the punctuation of a word and the kinds of its other characters, runs as one; a
word that repeats the one before it has a shape of its own. Each n-gram is one of ``2 ** BITS`` hashed
cells, so the model has a fixed size.

Learning, from at most ``PER_CLASS`` documents of each label: indicators are scaled by the log-count
ratio of their cell between the classes (add-one smoothed) and each document to length one; a linear
hinge-loss model is fitted by dual coordinate descent (Hsieh et al. 2008) until the duality gap is
``GAP`` of the loss, in one task, since the sample is bounded. The score is a logistic curve of the distance from the separating plane.

Texts are scored whole, of any length: they only say which cells are marked. An empty table gives no rows.
NULL and empty texts have no n-gram and get the score of the bias alone. Without both labels to learn from every
score is 0.5. All rows are kept, repeated ones included.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Lexicon, free_name, labelled_sample

BITS = 18
CELLS = 1 << BITS
PER_CLASS = 4000
COST, SEED = 1.0, 11
#: Descent ends when the loss is this share above its least value at most, by the duality gap, which is
#: looked at every few rounds.
GAP, LOOK = 1e-4, 5
CUT = 0.5
#: How steep the score is in the distance from the plane.
STEEP = 4.0


#: Mixed into the hashes of n-grams of each kind.
KINDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
STEP = np.uint64(0xD6E8FEB86659FD93)
SAME = np.uint64(zlib.crc32(b"="))


def shape_of(word: str) -> str:
    out, last = [], ""
    for c in word:
        kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "c" if c.isalpha() else c
        if kind != last:
            out.append(kind)
        last = kind
    return "".join(out)


def hashes_of(raw: bytes) -> tuple[int, int]:
    """Hashes of a word in lower case and of its shape."""
    word = raw.decode()
    return zlib.crc32(word.lower().encode()), zlib.crc32(shape_of(word).encode(), 1)


def lexicon() -> Lexicon:
    return Lexicon(hashes_of, "QQ")


def cells_of(text: str | None, known: Lexicon) -> np.ndarray:
    """The cells of all n-grams of a text, each once, in order."""
    numbers, (words, shapes) = known.look_up((text or "").encode().split())  # at the six blanks alone
    shapes[1:][numbers[1:] == numbers[:-1]] = SAME
    grams = [words, words[:-1] * STEP + words[1:], shapes, shapes[:-1] * STEP + shapes[1:]]
    grams.append((shapes[:-2] * STEP + shapes[1:-1]) * STEP + shapes[2:])
    marked = np.zeros(CELLS, bool)
    for kind, gram in zip(KINDS, grams):
        mixed = (gram + kind) * STEP
        mixed ^= mixed >> np.uint64(29)
        marked[(mixed * kind) >> np.uint64(64 - BITS)] = True
    return np.flatnonzero(marked)


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The log-count ratio of every cell between documents labelled 1 and 0."""
    counts = np.ones((2, CELLS))
    for cells, label in zip(rows, labels):
        counts[label, cells] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss support vector machine, by dual coordinate descent."""
    weights, bias = np.zeros(CELLS), 0.0
    dual = np.zeros(len(rows))
    # Both classes cost the same in all.
    cost = np.where(signs > 0, COST / max((signs > 0).mean(), 1e-9), COST / max((signs < 0).mean(), 1e-9)) / 2
    length = np.array([v @ v + 1 for v in values])
    chance = np.random.default_rng(SEED)
    rounds = 0
    while True:
        rounds += 1
        moved = False
        for i in chance.permutation(len(rows)):
            slope = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slope / length[i], 0.0), cost[i])
            step = (new - dual[i]) * signs[i]
            if step:
                dual[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                moved = True
        if not moved:
            break
        if rounds % LOOK == 0:
            size = weights @ weights + bias * bias
            margins = signs * np.array([weights[r] @ v + bias for r, v in zip(rows, values)])
            loss = size / 2 + cost @ np.maximum(1 - margins, 0)
            if loss - (dual.sum() - size / 2) <= GAP * loss:
                break
    return weights, bias


class Model:
    """Fixed size: two numbers for each cell, and the bias."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float):
        self.ratio, self.weight, self.bias = ratio.astype(np.float32), weight.astype(np.float32), bias

    def scaled(self, cells: np.ndarray) -> np.ndarray:
        values = self.ratio[cells].astype(float)
        length = np.sqrt(values @ values)
        return values / length if length else values

    def score(self, cells: np.ndarray) -> float:
        distance = float(self.weight[cells].astype(float) @ self.scaled(cells)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(STEEP * distance, -500, 500))))


def learn(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    model = Model(ratios(rows, labels), np.zeros(CELLS), 0.0)
    weight, bias = descend(rows, [model.scaled(c) for c in rows], np.where(labels > 0, 1.0, -1.0))
    return Model(model.ratio, weight, bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model | None:
    """Learn from at most ``per_class`` documents of each label; None without both labels."""

    def indicated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lexicon()
        for batch in batches:
            cells = [cells_of(text, known) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "cells": cells})

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "label": [], "cells": []}), *batches], ignore_index=True)
        rows = rows.sort_values("doc_id")  # the same order in any rerun
        if rows["label"].nunique() == 2:
            model = learn([np.asarray(c) for c in rows["cells"]], rows["label"].to_numpy(int))
            out = pd.DataFrame({"cell": np.arange(CELLS), "ratio": model.ratio, "weight": model.weight})
            out = out[(out["ratio"] != 0) | (out["weight"] != 0)]
            yield pd.concat([out, pd.DataFrame({"cell": [-1], "ratio": [0.0], "weight": [model.bias]})])

    sample = labelled_sample(docs, labels, label, per_class)
    marked = sample.mapInPandas(indicated, "doc_id long, label int, cells array<long>")
    kind = "cell long, ratio double, weight double"
    found = marked.repartition(1).mapInPandas(trained, kind).toArrow()  # CELLS + 1 rows at most
    if not found.num_rows:
        return None
    cell = found["cell"].to_numpy()
    ratio, weight = np.zeros(CELLS), np.zeros(CELLS)
    ratio[cell[:-1]], weight[cell[:-1]] = found["ratio"].to_numpy()[:-1], found["weight"].to_numpy()[:-1]
    return Model(ratio, weight, float(found["weight"].to_numpy()[-1]))


def score(df: DataFrame, model: Model | None, text: str = "text") -> Column:
    """A score from 0 to 1; the higher the likelier label 1."""
    if model is None:
        return F.lit(0.5)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, learnt = lexicon(), shared.value
        for batch in batches:
            yield pd.Series([learnt.score(cells_of(value, known)) for value in batch], dtype=float)

    return scored(F.col(text))


def judge(df: DataFrame, model: Model | None, into: str = "quality", text: str = "text") -> DataFrame:
    """``df`` with the score in a column of that name (underscores are added if it is taken)."""
    return df.withColumn(free_name(df, into), score(df, model, text))
