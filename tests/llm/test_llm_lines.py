from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import lines, queries

BLANKS = " \t\n\x0b\x0c\r"


def brute_key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))


def brute(texts, least_docs=10, least_chars=1, keep_first=False):
    """The kept text of every document, in order."""
    found, first = defaultdict(set), {}
    for doc, text in enumerate(texts):
        for place, line in enumerate((text or "").split("\n")):
            key = brute_key(line)
            if len(key) >= least_chars:
                found[key].add(doc)
                first.setdefault(key, (doc, place))
    out = []
    for doc, text in enumerate(texts):
        kept = []
        for place, line in enumerate((text or "").split("\n")):
            key = brute_key(line)
            common = len(key) >= least_chars and len(found[key]) >= least_docs
            if not common or keep_first and first[key] == (doc, place):
                kept.append(line)
        out.append(kept)
    return out


def many_texts(seed, docs=120):
    rng = random.Random(seed)
    pool = ["Hot line", "hot LINE ", "\tfoot er", "Größe", "größe", "x", " x", "漢字", "", "  "]
    pool += [f"shared {i}" for i in range(12)]
    out = []
    for doc in range(docs):
        body = rng.choices(pool, k=rng.randint(0, 6)) + [f"own {doc} {i}" for i in range(rng.randint(0, 3))]
        rng.shuffle(body)
        out.append("\n".join(body * rng.choice([1, 1, 2])))
    return out + [None, "", "\n", "\n\n hot line\n"]


@pytest.mark.parametrize("least_docs, least_chars, keep_first", [(10, 1, False), (1, 1, True), (2, 3, True), (1, 7, False)])
@pytest.mark.parametrize("ranges, batch", [(1, 10_000), (7, 5), (60, 3)])
def test_equals_brute_force(spark, change, least_docs, least_chars, keep_first, ranges, batch):
    change("spark.sql.shuffle.partitions", str(ranges))
    change("spark.sql.adaptive.coalescePartitions.enabled", "false")
    change("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    texts = many_texts(ranges)
    # One file, so that rows are numbered in this order.
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    limits = dict(least_docs=least_docs, least_chars=least_chars, keep_first=keep_first)
    wanted = brute(texts, **limits)
    for row in lines.with_bitmaps(df, **limits).collect():
        bits, kept = row.line_bits, wanted[row.doc_id]
        total = len((texts[row.doc_id] or "").split("\n"))
        assert (bits.n_lines, bits.n_dropped) == (total, total - len(kept))
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits.keep), np.uint8), bitorder="little")
        assert keep[total:].sum() == 0 and keep.sum() == len(kept)
        assert lines.kept_text(texts[row.doc_id], bits.keep) == "\n".join(kept)


def test_a_hot_line_over_several_ranges(spark, change):
    """One line in all documents: its run goes through all ranges."""
    change("spark.sql.shuffle.partitions", "9")
    change("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, 400, 1, 3).selectExpr("id AS doc_id", "concat('Hot\\nown ', id, '\\nhot') AS text")
    assert {r.text for r in lines.without_common_lines(df).collect()} == {f"own {i}" for i in range(400)}
    first = [r.text for r in lines.without_common_lines(df, least_docs=1, keep_first=True).collect()]
    assert Counter(t.startswith("Hot") for t in first) == {False: 399, True: 1}
    assert sum(t.count("hot") for t in first) == 0


@pytest.mark.parametrize("docs, gone", [(9, False), (10, True)])
def test_threshold(spark, docs, gone):
    rows = [(i, "Foot\nFoot\nfoot " if i < docs else "nothing") for i in range(30)]
    kept = lines.without_common_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.text for r in kept if r.doc_id < docs} == {"" if gone else "Foot\nFoot\nfoot "}


def test_edge_documents(edge, clashing, nothing):
    df = clashing("row_number", "line_bits", "n_lines", "of", "keep", "doc", "line", "dropped")
    marked = lines.with_bitmaps(df, least_docs=2)
    assert marked.columns == [*df.columns, "line_bits_"] and marked.count() == df.count()
    kept = lines.without_common_lines(df, least_docs=2)
    assert kept.columns == df.columns
    before, after = Counter(r.text for r in edge.collect()), Counter(r.text for r in kept.collect())
    twice = "one two three four five"
    assert after == before - Counter({twice: 2}) + Counter({"": 2})
    assert lines.with_bitmaps(nothing).collect() == [] and lines.without_common_lines(nothing).collect() == []
    with pytest.raises(ValueError, match="start at 1"):
        lines.without_common_lines(df, least_chars=0)


def test_very_long_text(spark):
    text = "\n".join(f"line {i % 5000}" for i in range(300_000))
    df = spark.createDataFrame([(1, text), (2, "line 7\nmine")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in lines.without_common_lines(df, least_docs=2).collect()}
    assert kept[2] == "mine" and kept[1].count("\n") == 300_000 - 60 - 1


def test_documents(spark, tables, sf_dir):
    found = queries.op13_lines(spark, sf_dir)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir, 'documents.parquet')}'")
    wanted = connection.sql(f"SELECT {', '.join(found.columns)} FROM ({lines.SQL})").fetchall()
    rows = [tuple(r) for r in found.collect()]
    assert Counter(rows) == Counter(wanted) and sum(r[2] for r in rows) > 0
    texts = {r.doc_id: r.text for r in tables("documents", "sf0.01").collect()}
    kept = dict(zip(texts, brute(list(texts.values()))))
    digest = {i: hashlib.sha256("\n".join(k).encode()).hexdigest() for i, k in kept.items()}
    assert {r[0]: r[3] for r in rows} == digest


def test_python_hash_of_equal_keys(spark):
    df = spark.createDataFrame([(1, "A b\n a B\t\n\na  b")], "doc_id long, text string").withColumn("n", F.lit(0).cast("long"))
    rows = lines.entries(df, "n", "text", 1).collect()
    assert [r.line for r in rows] == [0, 1, 3]
    assert len({(r.high, r.low) for r in rows}) == 2
