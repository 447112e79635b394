"""Toxic passages: maximum-scoring segments over token log-odds with Dirichlet priors.

1. Learning. In a bounded sample of labelled documents every token (a run of letters, lower case)
   is counted in toxic and in clean documents, as a whole and by its first five and four letters.
   Counts live in ``2 ** BITS`` hashed cells, so the model has a fixed size. The rate of a token is
   smoothed by a Dirichlet prior whose mean is the rate of its first five letters, which is
   smoothed by that of the first four, and that by the overall rate: forms of a word that were
   never seen get the rate of their stem. A token scores its log-odds against the overall rate,
   less one standard error and a drift, so that ordinary text scores below zero on average. A token that
   follows itself is less news each time: its n-th score in a row, if above zero, is divided by n.
2. Search. One scan finds all maximal scoring segments of a document (Ruzzo and Tompa). Tokens
   that score below zero only count through the sums between the others.
3. Calibration. A segment of score S among n tokens has the expected number of chance segments
   ``E = K n exp(-lambda S)`` (Karlin and Altschul); lambda and K come from clean documents of the
   quarter of the sample that was not counted. A document's evidence is the sum of -ln E over its
   segments with E < 1. The score is a logistic curve of the evidence that passes ``CUT`` at
   the value that separates the calibration documents best.

Texts are scanned whole, of any length, in linear time. Of documents with equal evidence the scores are equal; an empty
table gives no rows. NULL and empty texts have no token and get the score of no evidence. Without toxic labels to learn from
every score is 0. All rows are kept, repeated ones included.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Lexicon, free_name, labelled_sample, stored

TOKEN = re.compile(r"[^\W\d_]+")
BITS = 20
CELLS = 1 << BITS
PRIOR = 10.0
DRIFT = 0.2
#: No token scores more, or less than its negative.
MOST = 6.0
CUT = 0.7
PER_CLASS = 10_000
#: Candidates for lambda.
LAMBDAS = np.round(np.arange(0.1, 2.01, 0.1), 1)


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def cells_of(token: str) -> tuple[int, int, int]:
    """The cells of the first four letters, the first five, and the whole token."""
    return (
        zlib.crc32(b"4" + token[:4].encode()) & (CELLS - 1),
        zlib.crc32(b"5" + token[:5].encode()) & (CELLS - 1),
        zlib.crc32(b"w" + token.encode()) & (CELLS - 1),
    )


def score_of(token: str, toxic: np.ndarray, clean: np.ndarray, base: float) -> float:
    rate = base
    for cell in cells_of(token):
        bad = float(toxic[cell]) + PRIOR * rate
        good = float(clean[cell]) + PRIOR * (1 - rate)
        rate = bad / (bad + good)
    odds = math.log(bad / good) - math.log(base / (1 - base))
    error = math.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
    return min(max(odds - error - DRIFT, -MOST), MOST)


def scored(tokens: list[str], known: Lexicon) -> np.ndarray:
    numbers, (scores,) = known.look_up(tokens)
    if len(numbers):
        fresh = np.append(True, numbers[1:] != numbers[:-1])
        place = np.arange(len(numbers))
        turn = place - np.maximum.accumulate(np.where(fresh, place, 0)) + 1
        scores = np.where(scores > 0, scores / turn, scores)
    return scores


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, end): none overlap, each sums to more than
    zero and cannot be made better by extending or cutting it. Linear in the number of scores."""
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    # (sum before, sum behind, first, end, the latest earlier segment with a smaller sum before)
    found: list[tuple[float, float, int, int, int]] = []
    for place in places.tolist():
        left, right, first, end = sums[place], sums[place + 1], place, place + 1
        while True:
            back = len(found) - 1
            while back >= 0 and found[back][0] >= left:
                back = found[back][4]
            if back < 0 or found[back][1] >= right:
                found.append((left, right, first, end, back))
                break
            left, first = found[back][0], found[back][2]
            del found[back:]
    return [(float(right - left), first, end) for left, right, first, end, _ in found]


def count_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = np.zeros((2, CELLS), np.int64)
        for text, label in zip(batch["text"], batch["label"]):
            cells = [c for token in tokens_of(text) for c in cells_of(token)]
            np.add.at(counts[int(label)], cells, 1)
        cell = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"cell": cell, "toxic": counts[1, cell], "clean": counts[0, cell]})


def evidence_of(scores: np.ndarray, spread: float, chance: float) -> tuple[float, list[tuple[float, int, int]]]:
    """The evidence of a document, and the segments that make it."""
    log_size = np.log(chance * max(len(scores), 1))
    found = [(spread * s - log_size, first, end) for s, first, end in segments(scores)]
    found = [x for x in found if x[0] > 0]
    return float(sum(x[0] for x in found)), found


class Model:
    """Fixed size: two arrays of ``CELLS`` counts and five numbers."""

    def __init__(self, toxic, clean, rate, spread=1.0, chance=1.0, slope=1.0, middle=1.0):
        self.toxic, self.clean, self.rate = toxic, clean, rate
        self.spread, self.chance, self.slope, self.middle = spread, chance, slope, middle

    def scores(self) -> Lexicon:
        return Lexicon(lambda token: (score_of(token, self.toxic, self.clean, self.rate),), "d")

    def probability(self, evidence):
        shift = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shift + self.slope * (evidence - self.middle), -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model | None:
    """Learn from at most ``per_class`` documents of each label; None without both labels."""
    spark = docs.sparkSession
    counted = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)) != 0
    sample = stored(labelled_sample(docs, labels, label, per_class).select("text", "label", counted.alias("counted")))
    counts = (
        sample.where("counted")
        .select("text", "label")
        .mapInPandas(count_cells, "cell long, toxic long, clean long")
        .groupBy("cell")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toArrow()  # CELLS rows at most
    )
    toxic, clean = np.zeros(CELLS, np.float32), np.zeros(CELLS, np.float32)
    cell = counts["cell"].to_numpy()
    toxic[cell], clean[cell] = counts["toxic"].to_numpy(), counts["clean"].to_numpy()
    if not toxic.any() or not clean.any():
        return None
    total = toxic.sum(dtype=np.float64), clean.sum(dtype=np.float64)
    model = Model(toxic, clean, float(total[0] / (total[0] + total[1])))
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value.scores()
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"]):
                scores = scored(tokens_of(text), known)
                best = [s for s, _, _ in segments(scores)]
                growth = [float(np.exp(x * scores).sum()) for x in LAMBDAS]
                rows.append((int(label), len(scores), best, growth))
            yield pd.DataFrame(rows, columns=["label", "n", "best", "growth"])

    kind = "label int, n long, best array<double>, growth array<double>"
    # The part of the sample that was not counted: a quarter of a bounded number of documents.
    rows = sample.where("NOT counted").select("text", "label").mapInPandas(measure, kind).collect()
    calibrate(model, rows)
    return model


def calibrate(model: Model, rows: list) -> None:
    """Set lambda, K and the logistic curve from documents whose tokens were not counted."""
    plain = [r for r in rows if r.label == 0 and r.n]
    tokens = sum(r.n for r in plain)
    if tokens:
        growth = np.sum([r.growth for r in plain], axis=0) / tokens
        # The largest lambda at which ordinary text is not expected to grow.
        below = np.flatnonzero(growth <= 1)
        model.spread = float(LAMBDAS[below[-1]] if len(below) else LAMBDAS[0])
        mean = np.mean([r.n * np.exp(-model.spread * max(r.best, default=0.0)) for r in plain])
        model.chance = float(1 / max(mean, 1e-300))

    def evidence(row) -> float:
        size = np.log(model.chance * max(row.n, 1))
        return float(sum(x for x in (model.spread * s - size for s in row.best) if x > 0))

    values = np.array([evidence(r) for r in rows])
    labels = np.array([r.label for r in rows])
    if not len(values) or values.max() <= 0:
        return
    order = np.argsort(-values, kind="stable")
    values, labels = values[order], labels[order]
    hits = np.cumsum(labels)
    f1 = 2 * hits / (np.arange(1, len(labels) + 1) + max(labels.sum(), 1))
    last = np.append(values[1:] < values[:-1], True) & (values > 0)
    best = int(np.argmax(np.where(last, f1, -1)))
    lower = values[best + 1] if best + 1 < len(values) else 0.0
    model.middle = float((values[best] + lower) / 2)
    model.slope = float(2 / max(model.middle, 0.5))


KIND = "score double, evidence double, passages array<struct<first:long,end:long,evidence:double>>"


def score(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column: ``score`` (0 to 1), ``evidence``, ``passages`` (first and end token)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(KIND)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learnt = shared.value
        known = learnt.scores()
        for batch in batches:
            rows = []
            for value in batch:
                total, found = evidence_of(scored(tokens_of(value), known), learnt.spread, learnt.chance)
                passages = [{"first": f, "end": e, "evidence": s} for s, f, e in found]
                rows.append((float(learnt.probability(total)), total, passages))
            yield pd.DataFrame(rows, columns=["score", "evidence", "passages"])

    return judged(F.col(text))


def judge(df: DataFrame, model: Model | None, into: str = "toxicity", text: str = "text") -> DataFrame:
    """``df`` with a column ``score``, ``evidence``, ``passages`` of that name (underscores are
    added if it is taken)."""
    name = free_name(df, into)
    if model is None:
        nothing = F.struct(
            F.lit(0.0).alias("score"),
            F.lit(0.0).alias("evidence"),
            F.array().cast("array<struct<first:long,end:long,evidence:double>>").alias("passages"),
        )
        return df.withColumn(name, nothing)
    return df.withColumn(name, score(df, model, text))


def without_toxic(df: DataFrame, model: Model | None, cut: float = CUT) -> DataFrame:
    """The rows of ``df`` that score below ``cut``, in its own columns."""
    name = free_name(df, "toxicity")
    return judge(df, model, name).where(F.col(name)["score"] < cut).select(df.columns)
