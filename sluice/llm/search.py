"""Exact top-k search by inner product: distributed histogram selection.

Vectors are packed into blocks and stored. Each pass scores all blocks of queries against all blocks of
rows and counts scores in bins between a query's limits; the bin in which the k-th score lies becomes
the next limits, until a bin is one number wide: the exact k-th score. Where more rows have that score
than are wanted, the same passes over the ids find the last id to take. A last pass emits just the
rows above these two limits, ``k`` for each query, and ranks them.

A block of rows hands over its bins from the best down to where it alone reaches what is wanted, since no lower
bin can hold the k-th score; so a query gets at most ``k`` counts from a block in each pass, which are
added up before the shuffle. Scores are computed anew in each pass and never stored. Query blocks
are dealt to groups of row blocks; no group needs all vectors.

Components become floor(scale * x). Vectors that are NULL or hold a NULL, NaN or infinite component, and rows with a NULL id,
take no part. A shorter vector counts as padded with zeros. A query's own id is never among its rows, even
if several rows have it. Ties go to the smaller id. An empty table gives no rows; other columns, whatever their names, are
left out. Repeated rows are candidates each; two queries with one id are answered
both. A score of 2 ** 62 or more, either way, ends the search by an error, as does a component that is no finite
number once it is scaled: such scores would be no longs, and ids would decide among them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import stored

K = 20
SCALE = 64
#: Vectors in a block.
QUERIES, ROWS = 512, 2048
BITS = 10
#: No score reaches it: the difference of any two is still a long.
LIMIT = 1 << 62
BLOCK = "block long, ids binary, values binary, dims int, most double, norm double, low long, high long"


def packed(size: int, scale: int):
    """Blocks of the usable vectors: ids, whole components (float64, row by row), the largest
    component and norm, the range of ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, rows = [], []

        def out() -> pd.DataFrame:
            dims = max(map(len, rows), default=0)
            values = np.zeros((len(rows), dims))
            for place, row in enumerate(rows):
                values[place, : len(row)] = row
            norm = float(np.sqrt((values * values).sum(axis=1)).max(initial=0.0))
            found = np.array(ids, np.int64)
            row = (0, found.tobytes(), values.tobytes(), dims, float(np.abs(values).max(initial=0.0)), norm, int(found.min()), int(found.max()))
            ids.clear()
            rows.clear()
            return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for vec_id, vector in zip(batch["vec_id"], batch["vector"]):
                vector = np.asarray(vector, np.float64)
                if np.isfinite(vector).all():
                    with np.errstate(over="ignore"):
                        vector = np.floor(vector * scale)
                    if not np.isfinite(vector).all():
                        raise ValueError(f"vector {vec_id} has a component too large to be scaled")
                    ids.append(int(vec_id))
                    rows.append(vector)
                    if len(rows) == size:
                        yield out()
        if rows:
            yield out()

    return run


def blocks(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    rows = vectors.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    made = rows.mapInPandas(packed(size, scale), BLOCK)
    return stored(made.withColumn("block", F.monotonically_increasing_id()))


def opened(ids: bytes, values: bytes, dims: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    matrix = np.zeros((len(found), wide))
    matrix[:, :dims] = np.frombuffer(values, np.float64).reshape(len(found), dims)
    return found, matrix


def scores(queries: np.ndarray, rows: np.ndarray, most: float) -> np.ndarray:
    """Whole inner products, exact: in the smallest type that holds all sums."""
    if most < 1 << 24:
        return (queries.astype(np.float32) @ rows.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (queries @ rows.T).astype(np.int64)

    def whole(matrix: np.ndarray) -> np.ndarray:
        return np.array([[int(x) for x in row] for row in matrix], object).reshape(matrix.shape)

    found = whole(queries) @ whole(rows).T
    if found.size and max(abs(found.min()), abs(found.max())) >= LIMIT:
        raise ValueError("a score of 2 ** 62 or more: scale the vectors down")
    return found.astype(np.int64)


def each_pair(work):
    """Runs ``work(row, ids of queries, ids of rows, scores)`` for every pair of blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                wide = max(pair.q_dims, pair.dims)
                q_ids, queries = opened(pair.q_ids, pair.q_values, pair.q_dims, wide)
                ids, rows = opened(pair.ids, pair.values, pair.dims, wide)
                found = scores(queries, rows, pair.q_most * pair.most * max(wide, 1))
                yield work(pair, q_ids, ids, found)

    return run


def wanted_by(pair, q_ids: np.ndarray, ids: np.ndarray, found: np.ndarray, done: bool):
    """Where a score is above the limits of its query, and where it is the last one wanted."""
    other = q_ids[:, None] != ids[None, :]
    low = np.asarray(pair.score_low, np.int64)[:, None]
    last = other & (found == low) if done else None
    return other, low, last


def count_pass(by_id: bool, shift: int, bits: int):
    """Counts of one pass: bins of scores from the best, or bins of ids from the least, in which the
    wanted rows of this block lie."""
    size = 1 << bits

    def work(pair, q_ids, ids, found):
        other, low, last = wanted_by(pair, q_ids, ids, found, by_id)
        need = np.asarray(pair.need, np.int64)
        if by_id:
            bins = (ids[None, :] - np.asarray(pair.id_low, np.int64)[:, None]) >> shift
            valid = last & (bins >= 0) & (bins < size) & np.asarray(pair.tied, bool)[:, None]
        else:
            bins = size - 1 - ((found - low) >> shift)  # the best first
            valid = other & (bins >= 0) & (bins < size)
        query, row = np.nonzero(valid)
        flat = np.bincount(query * size + bins[query, row], minlength=len(q_ids) * size).reshape(-1, size)
        before = np.cumsum(flat, axis=1) - flat
        query, cell = np.nonzero((flat > 0) & (before < need[:, None]))
        return pd.DataFrame({"q_block": pair.q_block, "place": query, "bin": cell, "n": flat[query, cell]})

    return work


def take_pass(k: int):
    def work(pair, q_ids, ids, found):
        other, low, last = wanted_by(pair, q_ids, ids, found, True)
        until = np.asarray(pair.id_high, np.int64)[:, None]
        query, row = np.nonzero((other & (found > low)) | (last & (ids[None, :] <= until)))
        out = pd.DataFrame(
            {"q_block": pair.q_block, "place": query, "query_id": q_ids[query], "vec_id": ids[row], "score": found[query, row]}
        )
        # More than k only where one id is repeated.
        out = out.sort_values(["place", "score", "vec_id"], ascending=[True, False, True], kind="stable")
        return out[out.groupby("place").cumcount() < k]

    return work


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    groups: int | None = None,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` best rows for every row of
    ``df`` that is a query; ties go to the smaller id."""
    spark = df.sparkSession
    vectors = df.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(~F.exists(vector, lambda x: x.isNull()), F.col(vector).cast("array<double>")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = blocks(vectors.select("vec_id", "vector"), ROWS, scale)
    queries = blocks(vectors.where("is_query").select("vec_id", "vector"), QUERIES, scale)
    # Groups of row blocks, each of which all query blocks are dealt to.
    groups = groups or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    limits = rows.agg(F.max("norm"), F.min("low"), F.max("high")).first()
    longest = queries.agg(F.max("norm")).first()[0]
    if limits[0] is None or longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    product = min(limits[0] * longest * (1 + 1e-9), float(LIMIT))  # the norms are rounded
    bound = min(math.ceil(product) + 1, LIMIT - 1)
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "ids", "values", "dims", "most")])
    asked = asked.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def over_pairs(state: DataFrame, work, kind: str) -> DataFrame:
        grid = rows.join(asked.join(state, "q_block"), "group")
        return grid.mapInPandas(each_pair(work), kind)

    def steps(span: int) -> Iterator[tuple[int, int]]:
        """The shift and the number of bits of each pass; each looks into one bin of the pass before."""
        rest = max(span - 1, 1).bit_length()
        while rest:
            bits = min(BITS, rest)
            rest -= bits
            yield rest, bits

    # One row per query block; arrays by the place in the block.
    size = (F.length("q_ids") / 8).cast("int")
    state = queries.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"))
    state = stored(
        state.select(
            "q_block",
            F.array_repeat(F.lit(-bound).cast("long"), size).alias("score_low"),
            F.array_repeat(F.lit(k).cast("long"), size).alias("need"),
            F.array_repeat(F.lit(limits[1]).cast("long"), size).alias("id_low"),
            F.array_repeat(F.lit(limits[2]).cast("long"), size).alias("id_high"),
            F.array_repeat(F.lit(False), size).alias("tied"),
        )
    )
    for by_id, span in ((False, 2 * bound + 1), (True, limits[2] - limits[1] + 1)):
        for shift, bits in steps(span):
            if by_id and state.where(F.exists("tied", lambda x: x)).isEmpty():
                break
            counts = over_pairs(state, count_pass(by_id, shift, bits), "q_block long, place int, bin int, n long")
            state = stored(narrowed(state, counts, by_id, shift, bits))
    found = over_pairs(state, take_pass(k), "q_block long, place int, query_id long, vec_id long, score long")
    best = Window.partitionBy("q_block", "place").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def narrowed(state: DataFrame, counts: DataFrame, by_id: bool, shift: int, bits: int) -> DataFrame:
    """The limits of the next pass: the bin in which the last wanted row lies."""
    one = state.select("q_block", F.posexplode(F.arrays_zip("score_low", "need", "id_low", "id_high", "tied")).alias("place", "x"))
    one = one.select("q_block", "place", "x.*")
    bins = counts.groupBy("q_block", "place", "bin").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("q_block", "place").orderBy("bin")
    bins = bins.withColumn("sum", F.sum("n").over(upto)).join(one.select("q_block", "place", "need"), ["q_block", "place"])
    # The first bin with which the sum reaches what is needed; none if there are too few rows at all.
    hit = bins.where("sum >= need AND sum - n < need").select(
        "q_block", "place", "bin", "n", (F.col("sum") - F.col("n")).alias("before")
    )
    one = one.join(hit, ["q_block", "place"], "left")
    met = F.col("bin").isNotNull()
    need = F.when(met, F.col("need") - F.col("before")).otherwise(F.col("need"))
    if by_id:
        low = F.when(met, F.col("id_low") + F.col("bin").cast("long") * (1 << shift)).otherwise(F.col("id_low"))
        new = {"id_low": low, "need": need}
        if shift == 0:
            new["id_high"] = F.when(F.col("tied") & met, low).otherwise(F.col("id_high"))
    else:
        above = ((1 << bits) - 1 - F.col("bin")).cast("long") * (1 << shift)
        new = {"score_low": F.when(met, F.col("score_low") + above).otherwise(F.col("score_low")), "need": need}
        if shift == 0:
            new["tied"] = met & (F.col("n") > need)
    one = one.withColumns(new)
    names = [c for c in state.columns if c != "q_block"]
    rows = F.sort_array(F.collect_list(F.struct("place", *names)))  # as many as a block has queries
    whole = one.groupBy("q_block").agg(rows.alias("rows"))
    return whole.select("q_block", *[F.col(f"rows.{c}").alias(c) for c in names])


SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
