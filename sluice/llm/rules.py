"""Quality rules: base counts, and the divergence of a document from language references.

Base rules fail documents of fewer than ``LEAST_WORDS`` words, and those in which over half of the words
stand in three-word windows that occur twice or more.

The method compares two histograms of a document, character classes and common words, to those of
each language by the Jensen-Shannon distance (square root of the divergence, base 2). References
are the counts of all documents of the corpus with that ``lang`` that pass the base rules and are not rejected
by the references made without this last condition, so that junk does not shape them. A
document is held against the language it is closest to, which need not be its own ``lang``. It is rejected if a
distance is over its limit; documents with fewer than ``LEAST_CHARS`` characters, or ``LEAST_COMMON``
words for the words, are too short for a histogram and are not held against it.

Counts are made in one pass and stored; references have one row per language with a word list.

NULL and empty texts have no words and fail. Where there is no reference for a document's ``lang`` (NULL, or a language
without a word list), the base rules alone decide: against other languages' references clean text
would look like junk. Its distances are given all the same. Long texts are counted whole. A document equally far from two
languages is closest to the first by name. An empty table gives no rows; other columns do not matter. Rows are kept, repeated ones
too.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

LEAST_WORDS, MOST_REPEATED = 50, 50
LEAST_CHARS, LEAST_COMMON = 300, 100
#: The limit of the character distance falls with the number n of characters: limit + slack / sqrt(n).
CHAR_LIMIT, CHAR_SLACK, WORD_LIMIT = 0.16, 2.5, 0.32
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
STOPS = ".,;:!?'\"()-"
#: The most common words of each language.
COMMON = {
    "de": "der die und in den von zu das mit sich des für im auf ist nicht dem eine ein als".split(),
    "en": "the of and to a in is that it for was on with as be by this are at from".split(),
    "es": "de la que el en y los se del las un por con no una para su es al lo".split(),
    "fr": "de la le et les des en un du que une est pour qui dans par au sur pas avec".split(),
}
WORDS = sorted({w for words in COMMON.values() for w in words})
PLACE = {w.encode(): i for i, w in enumerate(WORDS)}
CLASSES = "blank lower upper digit stop symbol accented other".split()
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FAILED = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
KIND = f"doc_id long, lang string, {COUNTS}, chars array<long>, common array<long>"


def class_of(c: str) -> int:
    if c in BLANKS:
        return 0
    if c in SYMBOLS:
        return 5
    if c in STOPS:
        return 4
    if not c.isascii():
        return 6 if unicodedata.category(c)[0] in "LM" else 7
    return 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 7


def class_table() -> np.ndarray:
    """The class of every code point of the basic plane; those beyond it count as its last."""
    return np.array([class_of(chr(i)) for i in range(1 << 16)], np.uint8)


def repeated(ids: np.ndarray, distinct: int) -> int:
    """Words in windows of three that occur twice or more."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-2] * distinct + ids[1:-1]
    if distinct > 2_000_000:  # the number of a window would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, times = np.unique(pairs * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(ids), bool)
    for step in range(3):
        covered[step : step + len(again)] |= again
    return int(covered.sum())


def counted(text: str | None, table: np.ndarray) -> tuple:
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at the six blanks alone
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    chars = np.bincount(table[np.minimum(codes, (1 << 16) - 1)], minlength=len(CLASSES))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    common = np.zeros(len(WORDS), np.int64)
    for word, times in zip(seen, np.bincount(ids, minlength=len(seen)).tolist()):
        place = PLACE.get(word.strip(b".,;:!?'\"()-").lower())
        if place is not None:
            common[place] += times
    symbols = int(chars[5])
    return (
        len(words),
        len(codes) - int(chars[0]),
        symbols,
        len(lines) - len(set(lines)),
        repeated(ids, len(seen)),
        chars.tolist(),
        common.tolist(),
    )


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """The base counts and histograms of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = class_table()
        for batch in batches:
            rows = [counted(t, table) for t in batch["text"]]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in KIND.split(", ")[2:]])
            out.insert(0, "lang", batch["lang"].to_numpy())
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col(text).alias("text"))
    return rows.mapInPandas(run, KIND)


def references(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Character classes, and common words with all others behind them, by language."""
    sums = (
        rows.where(F.col("lang").isin(sorted(COMMON)) & ~F.expr(FAILED))
        .groupBy("lang")
        .agg(
            F.sum("n_words").alias("n"),
            F.array(*[F.sum(F.col("chars")[i]) for i in range(len(CLASSES))]).alias("chars"),
            F.array(*[F.sum(F.col("common")[i]) for i in range(len(WORDS))]).alias("common"),
        )
        .collect()  # one row per word list
    )
    out = {}
    for row in sums:
        words = np.array([row["common"][WORDS.index(w)] for w in COMMON[row["lang"]]], float)
        out[row["lang"]] = (np.array(row["chars"], float), np.append(words, row["n"] - words.sum()))
    return out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of the rows of ``p`` to ``q``; both are counts."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = (q / max(q.sum(), 1))[None, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.maximum((left + right) / 2, 0))


def judged(rows: DataFrame, known: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``rows`` with ``base_failed``, ``char_distance``, ``word_distance``, ``closest``, ``kept``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in batches:
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["char_distance"], out["word_distance"], out["closest"], over = 0.0, 0.0, None, False
            if len(out) and known:
                chars, common = np.stack(out["chars"]).astype(float), np.stack(out["common"]).astype(float)
                n, size = out["n_words"].to_numpy(), chars.sum(axis=1)
                char_limit = CHAR_LIMIT + CHAR_SLACK / np.sqrt(np.maximum(size, 1))
                best = np.full(len(out), np.inf)
                for lang, (char_counts, word_counts) in sorted(known.items()):
                    words = common[:, [WORDS.index(w) for w in COMMON[lang]]]
                    words = np.column_stack([words, n - words.sum(axis=1)])
                    by_char = np.where(size >= LEAST_CHARS, distance(chars, char_counts), 0)
                    by_word = np.where(n >= LEAST_COMMON, distance(words, word_counts), 0)
                    far = np.maximum(by_char / char_limit, by_word / WORD_LIMIT)
                    near = far < best
                    best = np.where(near, far, best)
                    out["char_distance"] = np.where(near, by_char, out["char_distance"])
                    out["word_distance"] = np.where(near, by_word, out["word_distance"])
                    out["closest"] = np.where(near, lang, out["closest"])
                over = (best > 1) & out["lang"].isin(known).to_numpy()
            out["kept"] = ~out["base_failed"].astype(bool) & ~over
            yield out

    kind = f"{KIND}, base_failed boolean, char_distance double, word_distance double, closest string, kept boolean"
    return rows.withColumn("base_failed", F.expr(FAILED)).mapInPandas(run, kind)


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """The base counts of every row of ``df`` with ``base_failed``, both distances, ``closest`` and ``kept``."""
    rows = stored(counts(df, text))
    near = judged(rows, references(rows)).where("kept")
    return judged(rows, references(near.select(rows.columns))).drop("lang", "chars", "common")
