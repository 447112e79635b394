"""Phrase collocation mining by dynamic itemset counting.

A text, A-Z in lower case, is split into pieces at ``. , ; : ! ?`` and line breaks, a piece into words at blanks and
tabs. A phrase is one to ``longest`` words that follow each other in a piece; f is how often it does so in the documents
of a language (``lang``, NULL is ``und``). Phrases of two words or more with f >= ``least`` are candidates.

The rows are dealt into ``shards`` by a hash, and the shards are scanned again and again in the same order. Words are
counted from the first scan on. A longer phrase is counted from the scan after that by which both its parts
(without its last and without its first word) have reached ``least``, and then for one full cycle, through every shard
once. So all lengths are counted in the same scans, and a candidate is always counted whole: its parts are as frequent as itself.

Which phrases have reached ``least``, and in which scan, is kept in a table of ``CELLS`` bytes by hash, 16 MB however
large the corpus is. Phrases that share a cell share the earliest scan, which never changes again; but none
counts as frequent from an earlier scan than its own parts do. So a phrase may start too early, never in a scan that
is over, never too late and never twice: a full cycle is counted all the same, and what does
not reach ``least`` is dropped at its end. A fuller table costs time, not results.

A scan counts each task's rows in pieces of bounded size before anything is shuffled; the counts of a shard
are added to those of phrases whose cycle is not over, and stored.

A candidate cut after its first k words scores floor(10^6 * f * f / (l * r)), with l and r the counts of the two
parts; the lowest cut counts, of equal ones the smallest k. Arithmetic is in decimals of 38 digits: exact up
to f of 10^16, an error beyond. A candidate goes if a longer candidate that holds its words in a row, gone or not, has
a count of ``share`` percent of its own or more.

NULL and empty texts have no words, a language without words has no row. Repeated rows count again. Texts are read whole,
of any length; ids and other columns do not matter. An empty table gives no rows.
The table is read once for each scan (``shards`` times ``longest`` at most), so it must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

LEAST = 10
LONGEST = 3
SHARE = 50
TOP = 2000
#: Parts of a language that are ranked by themselves before all are.
PARTS = 64
SHARDS = 2
CELLS = 1 << 24
#: A cell of which no phrase is frequent so far. So there may be 254 scans.
NEVER = 255
#: Bytes of text that a task counts at once (or one text, if that is longer), and rows it hands over at once.
CHUNK, SLICE = 1 << 23, 1 << 16
SEED = 42
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Stands between pieces: itself a break, so no word.
BREAK = b"."
CLEAN = bytes(BREAK[0] if i in BREAKS else 0x20 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))
#: A phrase in one text: the scan it starts with, as the character of that number and one, its language, a line
#: feed (in no phrase), its words.
COUNTS = pa.schema([("key", pa.string()), ("n", pa.int64())])


class Chunk:
    """The texts that are counted at once."""

    def __init__(self):
        self.texts: dict[str, list[bytes]] = {}
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        clean = text.translate(CLEAN).replace(BREAK, b" . ") + b" ."
        self.texts.setdefault(lang, []).append(clean)
        self.size += len(clean)

    def numbered(self) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray, np.ndarray]:
        """All words in a row, by the numbers of their forms; of each form the word, the language, the
        hash, and whether it stands between pieces."""
        ids, words, langs, hashes, base = [], [], [], [], 0
        for lang, texts in self.texts.items():
            # Blanks at the ends of a text give empty words, which count as breaks.
            parts = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
            coded = parts.flatten().dictionary_encode()
            ids.append(coded.indices.to_numpy().astype(np.int64) + base)
            base += len(coded.dictionary)
            words.append(coded.dictionary.cast(pa.string()))
            langs.append(pa.repeat(pa.scalar(lang, pa.string()), len(coded.dictionary)))
            seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
            forms = coded.dictionary.cast(pa.large_binary()).to_pylist()
            hashes.append(np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in forms), np.uint64, len(forms)))
        words = pa.concat_arrays(words)
        between = pc.is_in(words, pa.array(["", BREAK.decode()])).to_numpy(zero_copy_only=False)
        return np.concatenate(ids), words, pa.concat_arrays(langs), np.concatenate(hashes), between

    def counts(self, born: np.ndarray, scan: int, shards: int, longest: int) -> Iterator[pa.RecordBatch]:
        """The counts of all phrases that are counted in this scan."""
        if not self.texts:
            return
        ids, words, langs, hashes, between = self.numbered()
        self.texts, total = {}, len(words)
        if scan < shards:
            real = pa.array(np.flatnonzero(~between))
            times, names = np.bincount(ids, minlength=total)[~between], langs.take(real).dictionary_encode()
            yield from handed_over(0, langs.take(real), words.take(real), times)
            # The count of all words of a language goes as that of the phrase of no words.
            sums = np.bincount(names.indices.to_numpy(), times, len(names.dictionary))
            yield from handed_over(0, names.dictionary, pa.array([""] * len(sums), pa.string()), sums)
        starts = born_in(born, hashes)
        starts[between] = NEVER  # so no phrase goes over the end of a piece
        starts, hashes = starts[ids], hashes[ids]
        codes = hashes
        for size in range(2, longest + 1):
            # Of the phrase at each place: when its first and its second part became frequent.
            first, second = starts[:-1], starts[1:]
            whole = (first != NEVER) & (second != NEVER)
            before = np.maximum(first, second)  # the scan before that in which it starts
            for start in range(max(scan - shards + 1, 1), scan + 1):
                now = np.flatnonzero(whole & (before == start - 1))
                if len(now):
                    places, times = groups(ids, now, size, total)
                    parts = [words.take(pa.array(ids[places + i])) for i in range(size)]
                    joined = pc.binary_join_element_wise(*parts, " ")
                    yield from handed_over(start, langs.take(pa.array(ids[places])), joined, times)
            if size < longest:
                codes = mixed(codes[:-1], hashes[size - 1 :])
                # It cannot be frequent before it is counted; a cell it shares may say so, and what holds the
                # phrase would start in a scan that is over. NEVER stays, as the largest.
                starts = np.maximum(born_in(born, codes), before)


def groups(ids: np.ndarray, places: np.ndarray, size: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the phrases at the places: one place of each, and how often it comes."""
    code = ids[places]
    for i in range(1, size):
        code = code * total + ids[places + i]
        if i < size - 1:  # small again, so that the next product fits
            code = np.unique(code, return_inverse=True)[1]
    _, one, times = np.unique(code, return_index=True, return_counts=True)
    return places[one], times


def mixed(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one word more."""
    return ((code << np.uint64(21)) | (code >> np.uint64(43))) ^ word


def born_in(born: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return born[(codes & np.uint64(len(born) - 1)).astype(np.int64)]


def handed_over(start: int, langs: pa.Array, phrases: pa.Array, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = pc.binary_join_element_wise(pc.binary_join_element_wise(chr(start + 1), langs, ""), phrases, "\n")
    whole = pa.RecordBatch.from_arrays([keys, pa.array(times.astype(np.int64))], schema=COUNTS)
    for first in range(0, whole.num_rows, SLICE):
        yield whole.slice(first, SLICE)


def of_keys(state: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``n`` for ``key``, ``n``."""
    named = state.withColumn("phrase", F.substring_index("key", "\n", -1))
    lang = F.substring(F.col("key"), F.lit(2), F.length("key") - F.length("phrase") - 2)
    return named.select(lang.alias("lang"), "phrase", "n")


def cell_of(lang: Column, phrase: Column, longest: int, cells: int = CELLS) -> Column:
    """The cell of a phrase shorter than ``longest``, by the same hash as in ``Chunk``."""
    words = F.split(phrase, " ")

    def hashed(size: int) -> Column:
        each = [F.xxhash64(lang, words[i]) for i in range(size)]
        code = reduce(lambda a, b: F.shiftleft(a, 21).bitwiseOR(F.shiftrightunsigned(a, 43)).bitwiseXOR(b), each)
        return code.bitwiseAND(cells - 1)

    by_size = F.when(F.size(words) == 1, hashed(1))
    for size in range(2, longest):
        by_size = by_size.when(F.size(words) == size, hashed(size))
    return by_size


def shard_counts(
    df: DataFrame, text: str, lang: str, shards: int, born: Broadcast, scan: int, longest: int, at_once: int
) -> DataFrame:
    """``key``, ``n`` of the phrases counted in a scan; several rows of a phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, chunk = born.value, Chunk()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk.add(name, value.as_py())
                if chunk.size >= at_once:
                    yield from chunk.counts(table, scan, shards, longest)
                    chunk = Chunk()
        yield from chunk.counts(table, scan, shards, longest)

    # All columns count for the shard, so that copies with ids of their own are spread.
    mine = df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable(df)]), F.lit(shards)) == scan % shards)
    name = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = mine.where(F.col(text) != "").select(name.alias("lang"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "key string, n long")


def hashable(df: DataFrame) -> list[str]:
    """Columns without maps or variants, which have no hash."""
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def newly_frequent(state: DataFrame, born: np.ndarray, scan: int, least: int, longest: int) -> int:
    """Enters the phrases of ``state`` that have reached ``least`` into the table; how many cells are new.

    They come as bitmaps of 4 KB, 512 at most.
    """
    frequent = of_keys(state.where(F.col("n") >= least))
    frequent = frequent.where((F.col("phrase") != "") & (F.size(F.split("phrase", " ")) < longest))
    found = frequent.select(cell_of(F.col("lang"), F.col("phrase"), longest, len(born)).alias("cell"))
    maps = (
        found.groupBy(F.shiftright("cell", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("cell").bitwiseAND((1 << 15) - 1)).alias("bits"))
        .collect()
    )
    new = 0
    for part, bits in maps:
        place = born[part << 15 : (part + 1) << 15]
        marked = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(place), bitorder="little")
        fresh = marked.astype(bool) & (place == NEVER)
        place[fresh] = scan
        new += int(fresh.sum())
    return new


def counted(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    shards: int = SHARDS,
    cells: int = CELLS,
    at_once: int = CHUNK,
) -> DataFrame:
    """``lang``, ``phrase``, ``n`` of all phrases of one to ``longest`` words that come ``least`` times or more, and of
    the phrase of no words, which comes as often as words do. ``cells`` is a power of two."""
    if least < 1 or longest < 2 or shards < 1 or longest * shards >= NEVER:
        raise ValueError("least is 1 or more, longest 2 or more, and longest times shards below 255")
    spark = df.sparkSession
    born = np.full(cells, NEVER, np.uint8)
    waiting, complete, scan, last = None, [], 0, shards - 1
    while scan <= last:
        sent = spark.sparkContext.broadcast(born)
        counts = shard_counts(df, text, lang, shards, sent, scan, longest, at_once)
        if waiting is not None:
            counts = counts.unionByName(waiting)
        state = counts.groupBy("key").agg(F.sum("n").alias("n"))
        over = F.ascii("key") - 1 + (shards - 1) == scan
        often = (F.col("n") >= least) | F.col("key").endswith("\n")
        state = stored(state.where(often | ~over))
        if newly_frequent(state, born, scan, least, longest):
            last = scan + shards  # the cycle of what starts with the next scan
        complete.append(of_keys(state.where(over & often)))
        waiting = state.where(~over)
        sent.unpersist()
        scan += 1
    return reduce(DataFrame.unionAll, complete)


def scored(phrases: DataFrame) -> DataFrame:
    """The candidates among ``phrases`` with their count ``a``, and ``l``, ``r`` and ``score`` of the lowest cut."""
    part = phrases.where("phrase <> ''")
    size = F.size(F.split("phrase", " "))
    cuts = (
        part.where(size > 1)
        .select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
        .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("right", F.expr("substr(phrase, length(left) + 2)"))
    )
    left = part.select(F.col("lang").alias("left_lang"), F.col("phrase").alias("left_part"), F.col("n").alias("l"))
    right = part.select(F.col("lang").alias("right_lang"), F.col("phrase").alias("right_part"), F.col("n").alias("r"))
    both = cuts.join(left, (cuts["lang"] == left["left_lang"]) & (cuts["left"] == left["left_part"])).join(
        right, (cuts["lang"] == right["right_lang"]) & (cuts["right"] == right["right_part"])
    )
    whole = "decimal(38,0)"
    square = (F.col("a").cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)")).cast(whole)
    product = (F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")).cast(whole)
    both = both.withColumn("square", (square * F.lit(1_000_000).cast("decimal(7,0)")).cast(whole)).withColumn("product", product)
    lowest = F.min(F.struct(F.expr("square div product").alias("score"), "k", "l", "r")).alias("lowest")
    return both.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score")


def runs_of(words: Column, size: int) -> Column:
    """All runs of ``size`` words that are shorter than the whole, joined."""
    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    some = F.when(F.size(words) > size, starts).otherwise(F.array().cast("array<int>"))
    return F.transform(some, lambda i: F.array_join(F.slice(words, i, size), " "))


def outweighed(candidates: DataFrame, longest: int) -> DataFrame:
    """``in_lang``, ``inner``, ``most``: the largest count of longer candidates around each shorter one."""
    words = F.split("phrase", " ")
    runs = F.flatten(F.array(*[runs_of(words, size) for size in range(2, longest)]))
    inside = candidates.select(F.col("lang").alias("in_lang"), F.explode(runs).alias("inner"), "a")
    return inside.groupBy("in_lang", "inner").agg(F.max("a").alias("most"))


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
    top: int | None = TOP,
    **scans: int,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the ``top`` phrases of each language
    (all, if None): by score, then count, the highest first, then by the bytes of the phrase. ``scans`` as
    in ``counted``; they change no result."""
    phrases = counted(df, text, lang, least, longest, **scans)
    found = stored(scored(phrases))
    if longest > 2:
        around = outweighed(found, longest)
        found = found.join(around, (found["lang"] == around["in_lang"]) & (found["phrase"] == around["inner"]), "left")
        heavy = 100 * F.col("most").cast("decimal(22,0)") >= share * F.col("a").cast("decimal(22,0)")
        found = found.where(F.col("most").isNull() | ~heavy)
    order = "ORDER BY score DESC, a DESC, phrase"
    if top is not None:  # first in parts: the last task of a language then reads that many of each at most
        part = f"PARTITION BY lang, pmod(xxhash64(phrase), {PARTS}) {order}"
        found = found.withColumn("rank", F.expr(f"row_number() OVER ({part})")).where(F.col("rank") <= top)
    ranked = found.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    sums = phrases.where("phrase = ''").select(F.col("lang").alias("of"), "n")
    whole = ranked.join(sums, ranked["lang"] == sums["of"])
    return whole.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows for phrases of two and three words. HUGEINT has 38 digits.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), rows AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM rows WHERE len(w) > 0
), grams AS (
  SELECT lang, 1 AS k, w[i] AS phrase FROM placed
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), words AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT lang, k, phrase, a, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM words
  UNION ALL SELECT lang, k, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM words WHERE k = 3
), scores AS (
  SELECT c.lang, c.k, c.phrase, a, cut, l.f AS l, r.f AS r, (1000000 * a * a) // (l.f * r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), around AS (
  SELECT lang, inner_phrase, max(a) AS most FROM (
    SELECT lang, a, w[1] || ' ' || w[2] AS inner_phrase FROM words WHERE k = 3
    UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM words WHERE k = 3)
  GROUP BY ALL
), kept AS (
  SELECT p.* FROM lowest p LEFT JOIN around o ON p.lang = o.lang AND p.phrase = o.inner_phrase
  WHERE o.most IS NULL OR 100 * o.most < 50 * p.a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals ON kept.lang = totals.lang
QUALIFY rank <= 2000
"""
