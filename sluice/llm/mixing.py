"""Mixing sources to target weights by systematic sampling.

Sizes are words; a source's size is the sum of its documents'. Sources in the order of their code
points, NULL last, get ``weights`` in turn and share ``share`` times all sizes; a target stops at
``most`` times its source's size, and the excess is shared again by weight until none is above.

Every document of a source has the same expected number of copies, target / size of the source. The
prefix sum of these over the documents, plus one random offset for the source, is emitted
once for each whole number it crosses. Documents are taken in the order of size (then of a hash of
the id), so the copies are spread over all sizes and a source's words come within about one
document of its target. The offset is a hash of ``seed`` and the source, so reruns agree.

The prefix sum needs a document's place in its source. It is added up from three counts: of smaller
documents in the source, of documents of the same size in earlier hash buckets, and the place in
the bucket; so neither a hot source nor many documents of one size meet in one task.

NULL texts have size 0; NULL sources are one source. Documents of size 0 count as documents. Repeated
rows are documents of their own; of documents with the same id and size it is not said which one is taken first.
In an empty source (all sizes 0) nothing is taken, from an empty table neither. Texts are counted whole, of any
length. ``mix`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import WORD, free_name, numbered, ranked, stored

WEIGHTS = (3, 1, 2)
SHARE, MOST, SEED = 1.5, 2.0, "mix"
#: Hex digits of the hash that make a bucket of documents with the same source and size.
DIGITS = 2


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``source``, ``source_size`` with ``target`` (one row per source)."""
    rows = ranked(sizes, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stored(rows.select("source", "source_size", weight.alias("weight")))
    limit = F.col("source_size") * F.lit(most)
    level = 0.0
    while True:  # the level of target per weight only rises, each round stops another source at least
        open_ = limit >= F.col("weight") * F.lit(level)
        total, stopped, weight_left = rows.agg(
            F.sum("source_size"), F.sum(F.when(~open_, limit)), F.sum(F.when(open_, F.col("weight")))
        ).first()
        if not weight_left:
            level = float("inf")
            break
        rise = (share * (total or 0) - (stopped or 0.0)) / weight_left
        if rise <= level:
            break
        level = rise
    target = F.least(limit, F.col("weight") * F.lit(level)) if level != float("inf") else limit
    return rows.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """``docs`` (``doc_id``, ``source``, ``size`` and others) with ``source_size``, ``target`` and
    ``copies``: how often the mix takes the document."""
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = docs.withColumn("mark", mark).withColumn("bucket", F.substring("mark", 1, DIGITS))
    # NULL is a source too, so keys are made that compare.
    docs = docs.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    sums = stored(docs.groupBy("source", "key").agg(F.sum("size").alias("source_size")))
    goals = targets(sums.select("source", "source_size"), **shares)
    goals = goals.withColumn("of", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")

    cells = docs.groupBy("key", "size", "bucket").count()
    same_size = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("count").over(same_size), F.lit(0)))
    sized = docs.groupBy("key", "size").count()
    smaller = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.withColumn("smaller", F.coalesce(F.sum("count").over(smaller), F.lit(0))).drop("count")
    cells = cells.join(sized, ["key", "size"]).select("key", "size", "bucket", (F.col("before") + F.col("smaller")).alias("before"))

    here = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("mark"))
    placed = docs.withColumn("here", here).join(cells, ["key", "size", "bucket"])
    placed = placed.withColumn("place", F.col("here") + F.col("before"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("key")).cast("binary")), 1, 8), 16, 10)
    offset = start.cast("long") / F.lit(float(1 << 32))

    def crossed(place: Column) -> Column:
        return F.floor(place * expected + offset)

    return (
        placed.join(goals, placed["key"] == goals["of"])
        .withColumn("copies", crossed(F.col("place")) - crossed(F.col("place") - 1))
        .drop("key", "mark", "bucket", "here", "before", "place", "of")
    )


def mix_sizes(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words) of every row."""
    rows = stored(df.select("doc_id", "source", words(F.col(text)).alias("size")))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return copies(rows, **options).select("doc_id", "size", "source_size", "target", taken)


def mix(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, in its own columns."""
    number = free_name(df, "row_number")
    kept = numbered(df, number)
    rows = stored(kept.select("doc_id", "source", words(F.col(text)).alias("size"), F.col(number).alias("number")))
    taken = copies(rows, **options).where("copies > 0").select(F.col("number").alias(number), F.col("copies").alias("copies"))
    times, each = free_name(df, "times"), free_name(df, "each")
    taken = taken.withColumnRenamed("copies", times)
    rows = kept.join(taken, number).withColumn(each, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return rows.select(df.columns)


SQL = r"""
WITH d AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mark
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s
), f AS (  -- what all would get at the level at which this source stops
    SELECT a.source, a.source_size, a.weight,
           sum(least(2 * b.source_size * a.weight, 2 * a.source_size * b.weight)) AS used
    FROM w AS a, w AS b GROUP BY ALL
), l AS (
    SELECT *, used * 2 <= 3 * weight * (SELECT sum(source_size) FROM s) AS stopped FROM f
), v AS (
    SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE
            - coalesce(sum(2 * source_size) FILTER (stopped), 0)::DOUBLE)
           / (sum(weight) FILTER (NOT stopped))::DOUBLE AS level
    FROM l
), t AS (
    SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight::DOUBLE * level) AS target,
           CAST('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS start
    FROM l, v
), p AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.start,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0::DOUBLE END AS expected,
           (row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.mark))::DOUBLE AS place
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((floor(place * expected + start) - floor((place - 1) * expected + start)) * size AS BIGINT) AS taken
FROM p
"""
