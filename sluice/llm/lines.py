"""Line dedup: lines that many documents share, found by hash ranges, returned as keep bitmaps.

A text is split at line feeds. A line's key is the line without the six blanks at both ends and with
A-Z in lower case. Keys of at least ``least_chars`` code points that stand in at least ``least_docs``
documents are common: their lines go in every document, or with ``keep_first`` in all places but the first
(in the order of the rows, then of the lines).

Every line with such a key becomes a row of 128 bits of hash, document and line number. Rows are cut into
ranges by hash and document, so that a line of very many documents is spread over several tasks, sorted
by hash, document and line, and streamed. A run of equal hashes counts its documents; until they are
enough at most ``least_docs`` - 1 documents of it are remembered, from then on its rows leave at once. Only
the first and the last run of a range may go on in another one: what is undecided of these (the same bound)
is decided by the sum of their counts.

What comes back is one row per document: the number of its lines, of those that go, and a compressed
bitmap of those that stay. No text is in it; ``kept_lines`` applies a bitmap to a text.

NULL and empty texts are one empty line. Every row is a document, rows with repeated or NULL ids too.
Long texts are rows of many lines, nothing else. Empty tables give empty results; columns of any name are
left as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import free_name, numbered, stored

LEAST_DOCS = 10
LEAST_CHARS = 1
BLANKS = b" \t\n\x0b\x0c\r"
#: Rows handed over at once.
SLICE = 1 << 16
SURE, EDGE, SUM = 0, 1, 2
KEY = ["high", "low"]
ENTRY = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc", pa.int64()), ("line", pa.int64())])
#: Lines to drop (SURE), lines at the edge of a range (EDGE), what an edge run adds up to (SUM).
FOUND = pa.schema([("kind", pa.int8()), *ENTRY, ("docs", pa.int64())])


def key_of(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()  # bytes: only A-Z change


def line_hashes(text: str, least_chars: int) -> tuple[np.ndarray, list[int]]:
    """The hash of every key that is long enough, as two longs, and its line."""
    digests, places = [], []
    for place, line in enumerate(text.encode().split(b"\n")):
        key = key_of(line)
        if len(key) >= least_chars and (least_chars <= 1 or len(key.decode()) >= least_chars) and key:
            digests.append(xxhash.xxh3_128_digest(key))
            places.append(place)
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2), places


def entries(rows: DataFrame, number: str, text: str, least_chars: int) -> DataFrame:
    """``high``, ``low``, ``doc``, ``line`` of every line with a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, docs, lines, size = [], [], [], 0
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, places = line_hashes(value.as_py() or "", least_chars)
                if not places:
                    continue
                hashes.append(found)
                docs.append(np.full(len(places), doc))
                lines.append(np.array(places))
                size += len(places)
                if size >= SLICE:
                    yield from sliced(hashes, docs, lines)
                    hashes, docs, lines, size = [], [], [], 0
        if size:
            yield from sliced(hashes, docs, lines)

    def sliced(hashes: list, docs: list, lines: list) -> Iterator[pa.RecordBatch]:
        both = np.concatenate(hashes)
        columns = [both[:, 0], both[:, 1], np.concatenate(docs), np.concatenate(lines)]
        yield from in_slices([np.ascontiguousarray(c) for c in columns], ENTRY)

    return rows.select(number, text).mapInArrow(run, "high long, low long, doc long, line long")


def in_slices(columns: list[np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    for start in range(0, whole.num_rows, SLICE):
        yield whole.slice(start, SLICE)


class OpenRun:
    """A run of equal hashes that may go on in the next batch, or in another range."""

    def __init__(self, first: np.ndarray, heads_range: bool):
        self.first, self.key, self.heads_range = first, tuple(first[:2]), heads_range
        self.docs, self.last_doc, self.held, self.begun = 0, None, [], False

    def add(self, rows: np.ndarray) -> None:
        another = rows[1:, 2] != rows[:-1, 2]
        self.docs += int(another.sum()) + (rows[0, 2] != self.last_doc)
        self.last_doc = rows[-1, 2]
        self.held.append(rows)

    def taken(self) -> np.ndarray:
        """The rows that wait, which then wait no more."""
        rows, self.held = np.concatenate(self.held), []
        return rows


def stream(least_docs: int, keep_first: bool):
    """For rows sorted by hash, document and line: those to drop, as ``FOUND``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_run = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(4)])
            starts = np.append(0, np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1)
            done = 0  # runs of this batch that are dealt with
            if open_run is None or open_run.key == tuple(rows[0, :2]):
                open_run = open_run or OpenRun(rows[0], heads_range=True)
                yield from extended(open_run, rows[: starts[1]] if len(starts) > 1 else rows)
                done = 1
            if done < len(starts):
                yield from closed(open_run, ends_range=False)
                yield from whole_runs(rows[starts[done] : starts[-1]], starts[done:-1] - starts[done])
                open_run = OpenRun(rows[starts[-1]], heads_range=False)
                yield from extended(open_run, rows[starts[-1] :])
        if open_run is not None:
            yield from closed(open_run, ends_range=True)

    def whole_runs(rows: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        another = np.append(True, np.any(rows[1:, :3] != rows[:-1, :3], axis=1))
        docs = np.add.reduceat(another.astype(np.int64), starts)
        drop = np.repeat(docs >= least_docs, np.diff(np.append(starts, len(rows))))
        if keep_first:
            drop[starts] = False
        yield from found(rows[drop], SURE)

    def extended(run: OpenRun, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        run.add(rows)
        if run.docs < least_docs:
            return
        rows = run.taken()
        if keep_first and not run.begun:
            if run.heads_range:  # the range before may hold an earlier one
                yield from found(rows[:1], EDGE)
            rows = rows[1:]
        run.begun = True
        yield from found(rows, SURE)

    def closed(run: OpenRun, ends_range: bool) -> Iterator[pa.RecordBatch]:
        if run.heads_range or ends_range:
            yield from found(run.first[None, :], SUM, run.docs)
            if run.held:
                yield from found(run.taken(), EDGE)

    def found(rows: np.ndarray, kind: int, docs: int = 0) -> Iterator[pa.RecordBatch]:
        if len(rows):
            columns = [np.full(len(rows), kind), *rows.T, np.full(len(rows), docs)]
            yield from in_slices([np.ascontiguousarray(c) for c in columns], FOUND)

    return run


def common_lines(lines: DataFrame, least_docs: int, keep_first: bool) -> DataFrame:
    """``doc``, ``line`` of the rows of ``lines`` (stored) that go."""
    order = [*KEY, "doc", "line"]
    kind = "kind byte, high long, low long, doc long, line long, docs long"
    # Not by line: the rows of a hash in one document stay together, so that counts add up.
    ranges = lines.repartitionByRange(*KEY, "doc").sortWithinPartitions(*order)
    found = stored(ranges.mapInArrow(stream(least_docs, keep_first), kind))
    place = F.struct("doc", "line")
    sums = (
        found.where(F.col("kind") == SUM)
        .groupBy(*KEY)
        .agg(F.sum("docs").alias("all_docs"), F.min(place).alias("first"))
        .where(F.col("all_docs") >= least_docs)
    )
    edge = found.where(F.col("kind") == EDGE).join(sums, KEY)
    if keep_first:
        edge = edge.where(place != F.col("first"))
    return found.where(F.col("kind") == SURE).select("doc", "line").unionAll(edge.select("doc", "line"))


def packed_bits(n_lines: int, dropped: np.ndarray | None) -> bytes:
    keep = np.ones(n_lines, bool)
    if dropped is not None:
        keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def bitmaps(
    rows: DataFrame,
    number: str,
    text: str = "text",
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    keep_first: bool = False,
) -> DataFrame:
    """``number``, ``n_lines``, ``n_dropped``, ``keep`` for every row of ``rows``, which are stored and
    have a number of their own. ``keep`` has a bit for each line, the first line lowest, compressed by zlib."""
    if least_docs < 1 or least_chars < 1:
        raise ValueError("least_docs and least_chars start at 1: a line without a key never goes")
    lines = stored(entries(rows, number, text, least_chars))
    dropped = common_lines(lines, least_docs, keep_first).groupBy("doc").agg(F.collect_list("line").alias("dropped"))

    @F.pandas_udf("binary")
    def packed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sizes, places in batches:
            yield pd.Series([packed_bits(n, p) for n, p in zip(sizes, places)], dtype=object)

    whole = F.coalesce(F.col(text), F.lit(""))
    sizes = rows.select(number, (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    marked = sizes.join(dropped, sizes[number] == dropped["doc"], "left")
    n_dropped = F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long")
    return marked.select(number, "n_lines", n_dropped.alias("n_dropped"), packed("n_lines", "dropped").alias("keep"))


def kept_text(text: str | None, keep: bytes) -> str:
    lines = (text or "").split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines), bitorder="little")
    if bits.all():
        return text or ""
    return "\n".join([line for line, bit in zip(lines, bits.tolist()) if bit])


def kept_lines(text: Column | str, keep: Column | str) -> Column:
    """The lines of ``text`` that ``keep`` has a bit for; the empty text if there are none."""

    @F.pandas_udf("string")
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, maps in batches:
            yield pd.Series([kept_text(t, k) for t, k in zip(texts, maps)], dtype=object)

    return kept(text, keep)


def with_bitmaps(df: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``df`` with ``n_lines``, ``n_dropped`` and ``keep`` in a struct ``line_bits``."""
    number, bits = free_name(df, "row_number"), free_name(df, "line_bits")
    rows = numbered(df, number)
    marks = bitmaps(rows, number, text, **limits)
    marks = marks.select(F.col(number).alias("of"), F.struct("n_lines", "n_dropped", "keep").alias(bits))
    # One shuffle of the texts. A partition's bitmaps are small beside its texts, which then need no sort.
    joined = rows.join(marks.hint("shuffle_hash"), rows[number] == marks["of"])
    return joined.select(*[rows[f"`{c}`"] for c in df.columns], F.col(bits))


def without_common_lines(df: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``df`` in its own columns; texts without their common lines (NULL stays NULL)."""
    marked = with_bitmaps(df, text, **limits)
    bits = marked.columns[-1]
    kept = F.when(F.col(text).isNotNull(), kept_lines(F.col(text), F.col(bits)["keep"]))
    return marked.withColumn(text, kept).select(*[f"`{c}`" for c in df.columns])


#: The same rows; a document is a row, here one per ``doc_id``.
SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT doc_id, line, place, key IN (SELECT key FROM common) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
