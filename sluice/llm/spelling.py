"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. For two different
words that holds just if their common prefix and common suffix together reach the length of the longer word
less one. Blocks of words are laid out as padded matrices of code points, and pairs of blocks are compared
as a whole: where the first and the last difference stand gives prefix and suffix of all pairs at once.

Not all blocks need to meet. Words of b code points meet those of b and of b + 1, in bucket b. A near
pair in it has prefix P and suffix S with P + S >= b - 1, so for any x either P >= x, or P < x and S >= b - x.
Cutting so in the middle gives two blocks of words for each word, by its head and by its foot,
and every near pair is in exactly one of them. Blocks of over ``LARGE`` words are cut again in the same way, between
what is already known of P and S, and so on, until they are small or only one place is open. (Then a block
holds, of each length, one word for each letter or pair of letters at most.) So no near pair is lost or
counted twice, a head that very many words share is spread, and no tile grows with the vocabulary.

``vocabulary`` counts words: runs of Latin letters, A-Z in lower case. ``thinned`` takes a code point from
some of them, chosen by a checksum of document and word, as typing errors to be found again.

A word's form is its near word with the largest count (ties: least in code-point order), if that count is
``RATIO`` times its own or more; its root is where its forms end. Counts grow along forms, so they end.

NULL and empty texts have no words; a NULL id counts as an empty one. Repeated rows count again. Long texts are
counted whole, long words compared whole. The empty word is near none. Words come out once each; empty tables give empty results.
Columns other than those asked for do not matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
THINNED = 31
#: Words in a block that is compared whole.
LARGE = 512
#: Code points compared at once.
TILE = 1 << 22
#: Words that a task counts before it hands them over.
REMEMBERED = 200_000
#: In Latin-1, where every letter is one byte: letters, A-Z in lower case; all else is blank.
LETTERS = bytes(
    ord(chr(i).lower()) if chr(i).isascii() and chr(i).isalpha() else i if i >= 0xC0 else 0x20 for i in range(256)
)


def counted(doc_id: object, text: str, thinned: int | None, least_chars: int, totals: Counter) -> None:
    """Adds the words of a text to ``totals``."""
    runs = text.encode("latin-1", "replace").translate(LETTERS).split()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, times in Counter([w for w in runs if len(w) >= least_chars]).items():
        if thinned:
            place = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
            if place % thinned == 0:
                place %= len(word)
                word = word[:place] + word[place + 1 :]
                if len(word) < least_chars:
                    continue
        totals[word] += times


def vocabulary(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    thinned: int | None = None,
) -> DataFrame:
    """``word``, ``n`` for the words of ``least_chars`` code points or more (at least 1), found
    ``least_count`` times or more. With ``thinned`` a word whose checksum that number divides loses a letter."""

    def handed_over(totals: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in totals], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(totals.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                counted(key, value.as_py() or "", thinned, least_chars, totals)
                if len(totals) > REMEMBERED:
                    yield handed_over(totals)
                    totals.clear()
        if totals:
            yield handed_over(totals)

    rows = df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def entry(bucket: Column, head: Column, foot: Column, cap: Column) -> Column:
    """A place in the block of all words in the bucket with the same first ``head`` and last ``foot``
    code points, where pairs count that have fewer than ``cap`` in common at the front."""
    return F.struct(bucket.alias("bucket"), head.alias("head"), foot.alias("foot"), cap.alias("cap"))


def halves(entries: DataFrame) -> DataFrame:
    """Every place (``word``, ``n``, ``at``) cut in the middle of what is open, with its ``block``."""
    at, one = F.col("at"), F.lit(1)
    open_places = at["bucket"] - one - at["head"] - at["foot"]
    x = at["head"] + ((open_places + one) / 2).cast("int")
    by_head = entry(at["bucket"], x, at["foot"], at["cap"])
    by_foot = entry(at["bucket"], at["head"], at["bucket"] - x, F.least(x, at["cap"]))
    cut = entries.select("word", "n", F.explode(F.array(by_head, by_foot)).alias("at"))
    length = F.length("word")
    begin = F.substring(F.col("word"), one, at["head"])
    end = F.substring(F.col("word"), length - at["foot"] + one, at["foot"])
    return cut.withColumn("block", F.xxhash64("at.bucket", "at.head", "at.foot", "at.cap", begin, end))


def blocks(words: DataFrame, large: int) -> DataFrame:
    """``words`` in all blocks where near words can be; none holds over ``large``, unless just one
    code point is open in it."""
    length, none = F.length("word"), F.lit(0)
    buckets = F.array(*[entry(b, none, none, b + F.lit(1)) for b in (length, length - F.lit(1))])
    entries = halves(words.select("word", "n", F.explode(buckets).alias("at")).where("at.bucket > 0"))
    small = []
    while True:
        entries = stored(entries)
        heavy = (
            entries.where("at.bucket - 1 - at.head - at.foot > 0")
            .groupBy("block")
            .agg(F.count(F.lit(1)).alias("size"))
            .where(F.col("size") > large)
            .select("block")
        )
        heavy = stored(heavy)
        small.append(entries.join(heavy, "block", "left_anti"))
        if heavy.isEmpty():
            break
        entries = halves(entries.join(heavy, "block", "left_semi").select("word", "n", "at"))
    whole = small[0]
    for part in small[1:]:
        whole = whole.unionByName(part)
    return whole.select("block", "at.bucket", "at.head", "at.foot", "at.cap", "word", "n")


def matrix(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, a row each, zeros behind them."""
    try:
        joined, kind = "".join([w.ljust(width, "\0") for w in words]).encode("latin-1"), np.uint8
    except UnicodeEncodeError:
        joined, kind = "".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), "<u4"
    return np.frombuffer(joined, kind).reshape(-1, width)


def in_common(same: np.ndarray) -> np.ndarray:
    """How many are the same before the first difference, along the last axis."""
    return np.where(same.all(axis=-1), same.shape[-1], same.argmin(axis=-1))


def near_pairs(codes: np.ndarray, short: np.ndarray, bucket: int, head: int, foot: int, cap: int):
    """Numbers of the near words of one block: rows of ``codes``, ``short`` those of ``bucket`` code points."""
    left, both = np.flatnonzero(short), []
    right = np.concatenate([left, np.flatnonzero(~short)])
    step = max(1, TILE // (len(right) * bucket))
    for start in range(0, len(left), step):
        rows = codes[left[start : start + step], None, :bucket]
        prefix = in_common(rows == codes[None, right, :bucket])
        same_length = in_common((rows == codes[None, left, :bucket])[..., ::-1])
        longer = in_common((rows == codes[None, right[len(left) :], 1 : bucket + 1])[..., ::-1])
        suffix = np.concatenate([same_length, longer], axis=1)
        # The longer word has one code point more on the right.
        enough = np.repeat([bucket - 1, bucket], [len(left), len(right) - len(left)])
        near = (prefix + suffix >= enough) & (prefix >= head) & (prefix < cap) & (suffix >= foot)
        places = np.arange(start, start + len(rows))
        near[:, : len(left)] &= places[:, None] < np.arange(len(left))  # once, and not with itself
        i, j = np.nonzero(near)
        both.append((left[start + i], right[j]))
    return [np.concatenate(side) for side in zip(*both)] if both else [np.zeros(0, np.int64)] * 2


def best_of_block(words: list[str], counts: np.ndarray, sizes: np.ndarray, limits: tuple) -> list[tuple]:
    """``word``, how many words of the block are near, largest count and word of these. Words are sorted."""
    bucket = limits[0]
    short = sizes == bucket
    if not short.any() or len(words) < 2:
        return []
    a, b = near_pairs(matrix(words, bucket + 1), short, *limits)
    if not len(a):
        return []
    me, other = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((other, -counts[other], me))
    me, other = me[order], other[order]
    firsts = np.flatnonzero(np.append(True, me[1:] != me[:-1]))
    times = np.diff(np.append(firsts, len(me)))
    return [
        (words[i], int(n), int(counts[j]), words[j]) for i, n, j in zip(me[firsts], times, other[firsts])
    ]


def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For places sorted by block and word: what each block knows of each of its words."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        starts = np.flatnonzero(np.append(True, np.diff(batch["block"].to_numpy()) != 0))
        if len(batch):
            yield known(batch, starts[:-1], starts[1:])
            rest = batch.iloc[starts[-1] :]  # the last block may go on
    if rest is not None and len(rest):
        yield known(rest.reset_index(drop=True), np.array([0]), np.array([len(rest)]))


def known(batch: pd.DataFrame, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    words, counts = batch["word"].to_numpy(), batch["n"].to_numpy()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    limits = batch[["bucket", "head", "foot", "cap"]].to_numpy()
    out = []
    for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        out += best_of_block(list(words[a:b]), counts[a:b], sizes[a:b], tuple(limits[a].tolist()))
    return pd.DataFrame(out, columns=["word", "n_near", "most", "near"])


def near_words(words: DataFrame, large: int = LARGE) -> DataFrame:
    """``word``, ``n_near`` (how many are near), ``near`` and ``most`` (the near word with the largest
    count, and that) for every word of ``words`` (``word`` once each, ``n``) that has a near word."""
    places = blocks(words, large).repartition("block").sortWithinPartitions("block", "word")
    found = places.mapInPandas(compared, "word string, n_near long, most long, near string")
    best = F.min(F.struct((-F.col("most")).alias("less"), "near"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("most"), F.col("best.near").alias("near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for ``word``, ``form``: where the forms of forms end. Each round doubles the way."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("on"))
        hop = now.join(ahead, now["root"] == ahead["at"], "left")
        now = stored(hop.select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, large: int = LARGE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for ``words`` (``word`` once each, ``n``)."""
    words = stored(words.select("word", "n"))
    near = near_words(words, large).withColumnRenamed("word", "of")
    much = F.col("most") >= ratio * F.col("n")
    linked = stored(
        words.join(near, words["word"] == near["of"], "left").select(
            "word",
            F.when(much, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(much, F.col("most")).alias("form_n"),
        )
    )
    ends = roots(linked.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return linked.join(ends, linked["word"] == ends["of"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same rows. Checksums are reckoned byte by byte; letters beyond ASCII (two bytes, the first 195) get
#: one-byte names for the edit distance.
SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256))::BIGINT AS i)
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(
    list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: ord(x)::BIGINT),
    lambda c: CASE WHEN c < 128 THEN [c] ELSE [195::BIGINT, c - 64] END)) AS b
  FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM bytes, crc
), thinned AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word,
    'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
    '!"#$%&()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\]^_`~') AS plain
  FROM thinned WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM words a JOIN words b
    ON length(a.plain) BETWEEN length(b.plain) - 1 AND length(b.plain) + 1 AND levenshtein(a.plain, b.plain) = 1
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, row(-other_n, other)) AS most_word, max(other_n) AS most
  FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN most_word END AS form,
         CASE WHEN most >= 10 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best ON w.word = best.word
), way AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT way.word, way.next, forms.form FROM way JOIN forms ON way.next = forms.word
)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n
FROM forms f JOIN way ON f.word = way.word AND way.next IS NULL
"""
