"""SimHash near-duplicates by multi-index hashing.

Fingerprint: words of the text with A-Z in lower case, shingles of ``words`` words joined by one
space (repeated shingles count again; a text with fewer words is one shingle), each hashed by
XXH64 with seed 42; a bit is set if it is set in over half the hashes. A text without words, or NULL, has
fingerprint zero, and is linked like any other.

Links: fingerprints that differ in at most ``distance`` bits. Equal fingerprints are one node. Each
64-bit fingerprint is cut into two segments of 32 bits, so linked fingerprints have a segment in which
at most ``distance // 2`` bits differ. Every fingerprint is entered under all keys within
half that radius of its two segments (for 4 bits: the segment and its 32 neighbours), so that
such segments meet under a common key; what meets is compared in full. With keys of 32 bits unrelated
fingerprints hardly ever meet.

A key under which many meet is not expanded into pairs: its members are joined into a forest,
with one link per member at most, by complete distances. Keys with over ``LARGE`` members are first cut
by the five pieces of the other segment, of which linked fingerprints share one (4 differing bits spoil
four pieces at most), which spreads them over tasks and loses no link.

Components come from the links by star contraction (``graph``). All rows are kept, repeated rows
and NULL ids too; ``component_id`` is the least id in the component (NULL if it has none). Bits set in just half of the
hashes are not set. Texts are hashed whole, of any length. An empty table gives no rows; ``one_of_each`` keeps all
columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import free_name, numbered, stored
from sluice.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
LARGE = 2048
#: Hashes whose bits are counted at once.
BLOCK = 1 << 14


def fingerprint_of(text: str | None, words: int = SHINGLE) -> int:
    found = (text or "").encode().lower().split()  # bytes: only A-Z change, only the six blanks split
    if not found:
        return 0
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(joined, SEED)
    starts = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in found], out=starts[1:])
    ends = (starts[words:] - 1).tolist()
    starts = starts.tolist()
    counts, total = np.zeros(64, np.int64), len(ends)
    for first in range(0, total, BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[first : first + BLOCK], ends[first : first + BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, words: int = SHINGLE) -> Column:
    """The fingerprint as a long (its 64 bits)."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = np.fromiter((fingerprint_of(t, words) for t in batch), np.uint64, len(batch))
            yield pd.Series(values.view(np.int64))

    return prints(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def pieces(bits: Column, count: int) -> Column:
    """A 32-bit number cut into ``count`` pieces of about equal length, as (which, value)."""
    edges = [32 * i // count for i in range(count + 1)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("piece"), F.shiftrightunsigned(bits, a).bitwiseAND((1 << (b - a)) - 1).alias("part"))
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
    )


def ball(segment: Column, radius: int) -> Column:
    """All 32-bit numbers within ``radius`` bits of ``segment``, once each."""
    found, last = F.array(segment), F.array(F.struct(segment.alias("key"), F.lit(-1).alias("bit")))
    for _ in range(radius):
        last = F.flatten(
            F.transform(
                last,
                lambda x: F.transform(
                    F.filter(F.sequence(F.lit(0), F.lit(31)), lambda bit: bit > x["bit"]),
                    lambda bit: F.struct(
                        x["key"].bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("key"),
                        bit.alias("bit"),
                    ),
                ),
            )
        )
        found = F.concat(found, F.transform(last, lambda x: x["key"]))
    return found


def forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join all values which chains of links within ``distance`` join."""
    waiting, links = values, []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            value = reached.pop()
            near = np.bitwise_count(waiting ^ value) <= distance
            if near.any():
                links += [(int(value), int(x)) for x in waiting[near]]
                reached += list(waiting[near])
                waiting = waiting[~near]
    return links


def link_groups(keys: list[str], distance: int):
    """For rows sorted by ``keys``: the forest of every run of equal keys."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            starts = np.flatnonzero((batch[keys] != batch[keys].shift()).any(axis=1).to_numpy())
            yield found(batch, starts[:-1], starts[1:])
            rest = batch.iloc[starts[-1] :]  # the last run may go on
        if rest is not None and len(rest):
            yield found(rest.reset_index(drop=True), np.array([0]), np.array([len(rest)]))

    def found(batch: pd.DataFrame, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
        values = batch["print"].to_numpy().view(np.uint64)
        links = [x for a, b in zip(starts, ends) for x in forest(values[a:b], distance)]
        return pd.DataFrame(np.array(links, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return linked


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` between the values of the column ``print`` (distinct longs): not all pairs,
    but as many as join what is linked."""
    if not 0 <= distance <= 7:
        raise ValueError("two segments and balls of radius one serve distances up to 7")
    radius = (distance // 2 + 1) // 2
    low = F.col("print").bitwiseAND(0xFFFFFFFF)
    high = F.shiftrightunsigned("print", 32)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), ball(low, radius).alias("keys")),
        F.struct(F.lit(1).alias("side"), ball(high, radius).alias("keys")),
    )
    entries = (
        prints.select("print", F.explode(sides).alias("x"))
        .select("print", F.col("x.side").cast("byte").alias("side"), F.explode("x.keys").alias("key"))
    )
    group = "PARTITION BY side, key"
    met = entries.selectExpr(
        "*", f"count(*) OVER ({group}) AS n", f"min(print) OVER ({group}) AS a", f"max(print) OVER ({group}) AS b"
    ).where("n > 1 AND (n > 2 OR (print = a AND bit_count(a ^ b) <= %d))" % distance)
    met = stored(met)
    pairs = met.where("n = 2").select("a", "b")
    kind = "a long, b long"
    few = met.where(f"n BETWEEN 3 AND {LARGE}").select("side", "key", "print")
    few = few.repartition("side", "key").sortWithinPartitions("side", "key")
    other = F.when(F.col("side") == 0, high).otherwise(low)
    many = (
        met.where(f"n > {LARGE}")
        .select("side", "key", "print", F.explode(pieces(other, distance + 1)).alias("x"))
        .select("side", "key", "x.piece", "x.part", "print")
    )
    many = many.repartition("side", "key", "piece", "part").sortWithinPartitions("side", "key", "piece", "part")
    return (
        pairs.unionAll(few.mapInPandas(link_groups(["side", "key"], distance), kind))
        .unionAll(many.mapInPandas(link_groups(["side", "key", "piece", "part"], distance), kind))
        .distinct()
    )


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``print``, ``root`` for the distinct longs ``print`` that are linked to another."""
    found = components(links(prints, distance))
    return found.select(F.col("node").alias("print"), "root")


def near_duplicates(
    df: DataFrame,
    words: int = SHINGLE,
    distance: int = DISTANCE,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` for every row of ``df``."""
    rows = stored(df.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), words).alias("print")))
    return labelled(rows, distance).select(
        "doc_id", as_hex(F.col("print")).alias("fingerprint"), "component_id"
    )


def labelled(rows: DataFrame, distance: int) -> DataFrame:
    """``rows`` (``doc_id``, ``print``) with the ``component_id``."""
    least = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = classes(least.select("print"), distance)
    # Fingerprints without a link are their own class.
    member = least.join(roots, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = member.join(names, "root").select(F.col("print").alias("of"), "component_id")
    return rows.join(of_print, rows["print"] == of_print["of"], "left").drop("of")


def one_of_each(df: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``df`` in its own columns, one of each component: that with the least ``doc_id``
    (NULL last), of repeated ids the first that was stored."""
    number, mark = free_name(df, "row_number"), free_name(df, "print")
    kept = numbered(df.withColumn(mark, fingerprint(F.col("text"), words)), number)
    rows = kept.select("doc_id", F.col(mark).alias("print"), F.col(number).alias("number"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "number")).alias("first")
    least = stored(rows.groupBy("print").agg(first))
    roots = classes(least.select("print"), distance)
    member = least.join(roots, "print", "left")
    chosen = member.groupBy(F.coalesce("root", "print").alias("root")).agg(F.min("first").alias("first"))
    chosen = chosen.select(F.col("first.number").alias(number))
    return kept.join(chosen, number, "left_semi").select(df.columns)
