"""Packing token sequences into fixed windows by non-negative least squares.

1. Every document becomes token ids, with one id behind them; the ids are stored. Whole windows of
   a document are sequences of their own; what remains is shorter than a window.
2. Shallow combinations, two or three lengths that fill a window exactly, are enumerated. How often each
   should be used is the non-negative least-squares solution against the histogram of all
   remainders (at most ``window - 1`` numbers, which is all that reaches the driver).
3. Every task realises its share of the solution on its own documents, ``CHUNK`` tokens at a time: the
   counts are scaled to the chunk and rounded along their running sum, which starts at another fraction in
   each chunk, so that over many chunks every combination comes as often as the solution has it, also
   those of less than one use a chunk. A combination is used as long as the chunk has its lengths.
4. The residual is packed greedily: the longest piece that fits, and if none fits the longest one is cut
   to fill the window. What is left open goes on to the next chunk; at the end of a partition it is
   cut into sequences whose lengths are powers of two, which are not padded.

So no sequence has padding, and nothing is shuffled. NULL and empty texts are one piece with
the end id alone. Repeated rows are packed each for itself; of pieces of one length the last read is taken first. Long texts
are cut into whole windows. An empty table gives no pieces; other columns, whatever their names, are left out.

The ids are those of the ``tokenizers`` file, special tokens in a text included. The same vocabulary is
read by ``tiktoken`` where a file of ranks is given, which is four times as fast; ``tokenizers`` takes
over where that fails.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

WINDOW = 1024
END = 0
#: Tokens that are packed together, and so held in memory, by one task.
CHUNK = 1 << 22
ROUNDS = 300
#: Longer texts are left to ``tokenizers``: the pattern engine of the other gives up on long blanks.
LONG = 1 << 20
OUT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


@lru_cache(maxsize=4)
def encoder(path: str, ranks: str | None, pattern: str | None):
    """A function from a text to its ids."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)

    def plain(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids

    if not ranks:
        return plain
    import tiktoken

    with open(ranks, "rb") as file:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    special = {token.content: number for number, token in slow.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=known, special_tokens=special)

    def encode(text: str) -> list[int]:
        if len(text) > LONG:
            return plain(text)
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            return plain(text)

    return encode


def tokenized(
    df: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None, end: int = END, text: str = "text"
) -> DataFrame:
    """``doc_id``, ``tokens`` (with the end id), ``ids`` (unsigned little-endian, 16 bits each if all
    fit, else 32) and ``width`` of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, ranks, pattern)
        for batch in batches:
            for first in range(0, len(batch), 500):
                part, rows = batch.iloc[first : first + 500], []
                for value in part["text"]:
                    ids = np.array([*encode(value or ""), end], "<u4")
                    width = 2 if ids.max() < 1 << 16 else 4
                    rows.append((len(ids), ids.astype(f"<u{width}").tobytes(), width))
                out = pd.DataFrame(rows, columns=["tokens", "ids", "width"])
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, tokens long, ids binary, width int")


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three of the given lengths (zero stands for none) that fill the window."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    a = np.arange(1, window // 2 + 1)
    a = a[present[a] & present[window - a]]
    found = [np.stack([np.zeros_like(a), a, window - a], 1)]
    for first in range(1, window // 3 + 1):
        if present[first]:
            second = np.arange(first, (window - first) // 2 + 1)
            second = second[present[second] & present[window - first - second]]
            found.append(np.stack([np.full_like(second, first), second, window - first - second], 1))
    return np.concatenate(found)


def solve(combos: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, by projected gradients with momentum.
    Column j of A counts the lengths of combination j."""
    if not len(combos):
        return np.zeros(0)
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        out = np.bincount(combos.ravel(), np.repeat(x, 3), size)
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[combos].sum(axis=1)

    goal = histogram.astype(float)
    goal[0] = 0
    scale = max(goal.max(), 1.0)
    x = np.ones(len(combos))
    for _ in range(20):
        x = back(used(x))
        steep = np.linalg.norm(x)
        x /= steep
    x = y = np.zeros(len(combos))
    pace = 1.0
    for _ in range(rounds):
        new = np.maximum(y - back(used(y) - goal / scale) / (1.02 * steep), 0)
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = new + (pace - 1) / next_pace * (new - x)
        x, pace = new, next_pace
    return x * scale


class Packer:
    """Packs the remainders of one partition. A piece is (doc_id, start, ids, tokens of its document)."""

    def __init__(self, combos: np.ndarray, share: np.ndarray, window: int):
        keep = share > 0
        order = np.argsort(-share[keep], kind="stable")
        self.combos, self.share = combos[keep][order], share[keep][order]
        self.window, self.open, self.room = window, [], window
        self.reached = np.zeros(len(self.share), np.int64)  # how often each combination was used

    def pack(self, pieces: list, start: float = 0.5) -> Iterator[list]:
        """Full sequences of the given pieces and of what was left open. Counts are rounded from the
        fraction ``start`` on."""
        by_length: dict[int, list] = {}
        for piece in pieces:
            by_length.setdefault(len(piece[2]), []).append(piece)
        uses = np.diff(np.floor(np.cumsum(self.share * len(pieces)) + start), prepend=0).astype(int)
        for place in np.flatnonzero(uses).tolist():
            combo = [int(n) for n in self.combos[place] if n]
            for _ in range(int(uses[place])):
                if any(len(by_length.get(n, ())) < combo.count(n) for n in combo):
                    break
                self.reached[place] += 1
                yield [by_length[n].pop() for n in combo]
        yield from self.greedy(by_length)

    def greedy(self, by_length: dict[int, list]) -> Iterator[list]:
        lengths = sorted(n for n, group in by_length.items() if group)
        while lengths:
            fits = bisect_right(lengths, self.room)
            length = lengths[fits - 1] if fits else lengths[-1]
            piece = by_length[length].pop()
            if not by_length[length]:
                lengths.remove(length)
            if length > self.room:
                doc_id, start, ids, tokens = piece
                rest = (doc_id, start + self.room, ids[self.room :], tokens)
                piece = (doc_id, start, ids[: self.room], tokens)
                group = by_length.setdefault(len(rest[2]), [])
                if not group:
                    insort(lengths, len(rest[2]))
                group.append(rest)
            self.open.append(piece)
            self.room -= len(piece[2])
            if not self.room:
                yield self.open
                self.open, self.room = [], self.window

    def rest(self) -> Iterator[list]:
        """What is left open, cut into sequences whose lengths are powers of two."""
        pieces, self.open = self.open[::-1], []
        left = sum(len(p[2]) for p in pieces)
        while left:
            room = size = 1 << (left.bit_length() - 1)
            out = []
            while room:
                doc_id, start, ids, tokens = pieces.pop()
                if len(ids) > room:
                    pieces.append((doc_id, start + room, ids[room:], tokens))
                    ids = ids[:room]
                out.append((doc_id, start, ids, tokens))
                room -= len(ids)
            left -= size
            yield out


def pack(tokens: DataFrame, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """Pieces of all documents of ``tokens`` (as ``tokenized`` gives them): ``doc_id``, ``start``,
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    rest = F.col("tokens") % window
    counts = tokens.groupBy(rest.alias("rest")).count().where("rest > 0").collect()  # window - 1 rows at most
    histogram = np.zeros(window + 1)
    for row in counts:
        histogram[row["rest"]] = row["count"]
    combos = combinations(np.flatnonzero(histogram), window)
    share = solve(combos, histogram) / max(histogram.sum(), 1)
    combos, share = combos[share > 0], share[share > 0]
    shared = tokens.sparkSession.sparkContext.broadcast((combos, share))  # as many as there are combinations

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(*shared.value, window)
        number = TaskContext.get().partitionId() << 32
        chance = np.random.default_rng(TaskContext.get().partitionId())  # the same in a rerun
        rows: list[tuple] = []

        def put(sequence: list) -> None:
            nonlocal number
            offset = 0
            for doc_id, start, ids, total in sequence:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((doc_id, start, len(ids), crc, total, number, offset))
                offset += len(ids)
            number += 1

        def out() -> pd.DataFrame:
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])
            rows.clear()
            return frame.astype({"doc_id": "Int64"})

        waiting, held = [], 0
        for batch in batches:
            for doc_id, total, raw, width in zip(batch["doc_id"], batch["tokens"], batch["ids"], batch["width"]):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                ids = np.frombuffer(raw, f"<u{width}")
                whole = total - total % window
                for start in range(0, whole, window):
                    put([(doc_id, start, ids[start : start + window], total)])
                if whole < total:
                    waiting.append((doc_id, whole, ids[whole:].copy(), total))
                    held += total - whole
                if held >= chunk:
                    for sequence in packer.pack(waiting, chance.random()):
                        put(sequence)
                    waiting, held = [], 0
                if len(rows) >= 10_000:
                    yield out()
        for sequence in packer.pack(waiting, chance.random()):
            put(sequence)
        for sequence in packer.rest():
            put(sequence)
        yield out()

    return tokens.select("doc_id", "tokens", "ids", "width").mapInPandas(run, OUT)


def packed(
    df: DataFrame,
    path: str,
    ranks: str | None = None,
    pattern: str | None = None,
    window: int = WINDOW,
    end: int = END,
    text: str = "text",
) -> DataFrame:
    return pack(stored(tokenized(df, path, ranks, pattern, end, text)), window)
