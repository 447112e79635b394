from __future__ import annotations

import re
from collections import Counter
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import data_files, file_sink, table_job
from sluice import observe_progress, read_progress, read_target, resolve_format, write_table
from sluice.sinks.files import spread_rows
from sluice_checks.queries import read_back


def keyed(spark, *pairs):
    return spark.createDataFrame(pairs, "k string, v int")


def read(spark, sink, job, schema="k string, v int"):
    names = [part.split()[0] for part in schema.split(", ")]
    path = f"{sink.get('location')}/{job.table_name}"
    reader = spark.read.format(resolve_format(sink.get("format"))).schema(schema)
    return sorted(map(tuple, reader.load(path).select(*names).collect()))


@pytest.mark.parametrize("format", ["parquet", "orc", "avro", "json", "csv"])
def test_formats(spark, tmp_path, format):
    sink, job = file_sink(tmp_path, format), table_job("a.t")
    path = write_table(keyed(spark, ("a", 1), ("b", 2)), sink, job, "completely")
    assert path == f"{tmp_path}/a.t"
    assert all(name.endswith(f".{format}") or format in name for name in data_files(path))
    assert read(spark, sink, job) == [("a", 1), ("b", 2)]


def test_only_avro_is_renamed():
    assert resolve_format("parquet") == "parquet"
    assert "avro" in resolve_format("AVRO").lower()


@pytest.mark.parametrize("format", ["parquet", "orc", "avro"])
def test_arrays_and_times(spark, tmp_path, sf_dir, format):
    for table in ("embeddings", "events"):
        df, sink = spark.read.parquet(f"{sf_dir}/{table}.parquet"), file_sink(tmp_path, format)
        path = write_table(df, sink, table_job(table), "completely")
        back = spark.read.format(resolve_format(format)).load(path)
        assert [t for _, t in back.dtypes] == [t for _, t in df.dtypes]
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_only_a_complete_copy_replaces(spark, tmp_path):
    sink, job = file_sink(tmp_path), table_job()
    write_table(keyed(spark, ("a", 1)), sink, job, "completely")
    for mode in ("daily", "incrementally", "weekly"):
        write_table(keyed(spark, ("a", 1)), sink, job, mode)
    assert read(spark, sink, job) == [("a", 1)] * 4
    write_table(keyed(spark, ("b", 2)), sink, job, "completely")
    assert read(spark, sink, job) == [("b", 2)]


@pytest.mark.parametrize("session", ["static", "dynamic"])
def test_a_complete_copy_leaves_no_old_partition(spark, tmp_path, change, session):
    change("spark.sql.sources.partitionOverwriteMode", session)
    sink, job = file_sink(tmp_path), table_job(partitionKeys="k")
    write_table(keyed(spark, ("a", 1), ("b", 2)), sink, job, "completely")
    write_table(keyed(spark, ("b", 3)), sink, job, "completely")
    assert read(spark, sink, job) == [("b", 3)]


def test_partition_folders(spark, tmp_path):
    df = keyed(spark, ("a", 1), ("b", 2), (None, 3)).withColumn("w", F.lit("007"))
    sink, job = file_sink(tmp_path), table_job(partitionKeys=" k, w ")
    path = write_table(df, sink, job, "completely")
    folders = {name.rsplit("/", 1)[0] for name in data_files(path)}
    assert folders == {"k=a/w=007", "k=b/w=007", "k=__HIVE_DEFAULT_PARTITION__/w=007"}
    rows = read(spark, sink, job, "w string, v int")
    assert rows == [("007", 1), ("007", 2), ("007", 3)]


def test_keys_in_other_spelling(spark, tmp_path):
    df = keyed(spark, ("a", 1)).withColumnsRenamed({"k": "LOAD_KEY"})
    sink, job = file_sink(tmp_path), table_job(partitionKeys="load_key")
    write_table(df, sink, job, "daily")
    assert read(spark, sink, job, "load_key string, v int") == [("a", 1)]
    assert spread_rows(df, ["load_key"]).count() == 1


def test_unknown_partition_key(spark, tmp_path):
    with pytest.raises(AnalysisException, match="nope"):
        write_table(keyed(spark), file_sink(tmp_path), table_job(partitionKeys="nope"), "daily")
    assert not data_files(tmp_path)


DAY = date(2024, 1, 10)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_a_replaced_day(spark, tmp_path, kind):
    sink = file_sink(tmp_path)
    job = table_job(mode="daily", partitionKeys="d,k", checkColumn="d", replacePartitions="true")

    def day(text, *pairs):
        df = keyed(spark, *pairs).withColumn("d", F.lit(text).cast(kind))
        write_table(df, sink, job, "daily", date.fromisoformat(text))

    day("2024-01-10", ("a", 1), ("b", 2))
    day("2024-01-11", ("a", 7))
    assert read(spark, sink, job) == [("a", 1), ("a", 7), ("b", 2)]
    day("2024-01-10", ("c", 1))  # one row has another second key, the other is gone
    assert read(spark, sink, job) == [("a", 7), ("c", 1)]
    day("2024-01-10")
    assert read(spark, sink, job) == [("a", 7)]


def test_a_replaced_day_with_times(spark, tmp_path):
    sink = file_sink(tmp_path)
    job = table_job(mode="daily", partitionKeys="D", checkColumn="d", replacePartitions="true")
    for times in (["2024-01-10 01:00:00", "2024-01-10 02:30:00.5"], ["2024-01-10 02:00:00"]):
        rows = spark.createDataFrame([("a", i, t) for i, t in enumerate(times)], "k string, v int, d string")
        write_table(rows.withColumn("d", F.col("d").cast("timestamp_ntz")), sink, job, "daily", DAY)
    assert read(spark, sink, job) == [("a", 0)]


def test_replacing_needs_the_day(spark, tmp_path):
    job = table_job(mode="daily", partitionKeys="k", checkColumn="k", replacePartitions="true")
    with pytest.raises(ValueError, match="day"):
        write_table(keyed(spark, ("a", 1)), file_sink(tmp_path), job, "daily")


def test_writer_options(spark, tmp_path):
    sink = file_sink(tmp_path, compression="gzip", maxRecordsPerFile="10")
    path = write_table(spark.range(0, 35, 1, 1), sink, table_job(), "completely")
    files = data_files(path)
    assert len(files) == 4 and all(".gz." in name for name in files)


def test_default_write_has_a_file_per_task_and_key(spark, tmp_path):
    df = spark.range(0, 400, 1, 4).select((F.col("id") % 5).alias("k"), "id")
    path = write_table(df, file_sink(tmp_path), table_job(partitionKeys="k"), "completely")
    assert len(data_files(path)) == 20


def test_rebalanced_write_splits_only_the_hot_key(spark, tmp_path, change):
    change("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    change("spark.sql.shuffle.partitions", "100")
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60)
    df = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), "id", F.rand(1).alias("r"))
    df, observation = observe_progress(spread_rows(df, ["k"]), "id")
    path = write_table(df, file_sink(tmp_path), table_job(partitionKeys="k"), "completely")
    assert read_progress(observation) == (300_000, "299999")
    per_key = Counter(name.split("/")[0] for name in data_files(path))
    assert len(per_key) == 41
    assert per_key.pop("k=0") > 4 and max(per_key.values()) <= 3
    assert spark.read.parquet(path).distinct().count() == 300_000


def test_keys_of_any_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2)], "`a.b` int, `c d` string, v int")
    job = table_job(partitionKeys="a.b,c d")
    path = write_table(spread_rows(df, job.partition_keys), file_sink(tmp_path), job, "daily")
    assert data_files(path)[0].startswith("a.b=1/c d=x/")


KEYS = [
    ("string", ["a b", "a+b", "%41", "x=1/2", "ä€", "\u00a0", "__x", "7", "007", " ", "a:b", "[*]{?}", "#", "\\", "\n", "", None]),
    ("timestamp_ntz", ["2024-01-10 00:00:00", "2024-01-10 23:59:59.999999", "2024-01-10 01:02:03.5", None]),
    ("timestamp", ["2024-03-31 01:30:00", "2024-10-27 00:30:00.000001", None]),
    ("date", ["2024-01-10", "0001-01-01", None]),
    ("double", ["NaN", "Infinity", "1e300", "-0.1", None]),
    ("decimal(12,3)", ["1.5", "-999999999.999", None]),
    ("bigint", ["-9223372036854775808", "0", None]),
    ("boolean", ["true", "false", None]),
]


@pytest.mark.parametrize("format", ["parquet", "orc", "avro", "json", "csv"])
@pytest.mark.parametrize("kind, values", KEYS, ids=[kind for kind, _ in KEYS])
def test_keys_come_back_from_their_folders(spark, tmp_path, monkeypatch, kind, values, format):
    monkeypatch.setattr("sluice.sinks.files.FOUND_BY_SPARK", 0)
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, v int")
    rows = rows.select("v", F.col("k").cast(kind).alias("a.k = %"), F.lit("x y").alias("Other"))
    job = table_job(partitionKeys="A.K = %,other")
    path = write_table(rows, file_sink(f"{tmp_path}/to %20", format), job, "daily")
    back = read_target(spark, path, format, rows.schema, job.partition_keys)
    assert back.dtypes == rows.dtypes
    wanted = [(v, None if key == "" else key, other) for v, key, other in rows.collect()]  # Spark's layout
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, wanted))
    found = spark.read.format(resolve_format(format)).schema(rows.schema).load(path).select("v", "`a.k = %`", "Other")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, found.collect()))


@pytest.mark.parametrize("found", [-1, 20_000])
def test_a_target_without_rows(spark, tmp_path, monkeypatch, found):
    monkeypatch.setattr("sluice.sinks.files.FOUND_BY_SPARK", found)
    job = table_job(partitionKeys="k")
    path = write_table(keyed(spark, ("a", 1)).limit(0), file_sink(tmp_path), job, "daily")
    assert read_target(spark, path, "parquet", keyed(spark, ("a", 1)).schema, job.partition_keys).collect() == []


@pytest.mark.parametrize("found", [299, 20_000])
def test_many_folders_are_opened_by_few_tasks(spark, tmp_path, monkeypatch, found):
    """With more than ``found`` files Spark's own list of partitions is left out: it takes steps that grow with
    their square."""
    monkeypatch.setattr("sluice.sinks.files.FOUND_BY_SPARK", found, raising=False)
    rows, sink, job = spark.range(300).selectExpr("id AS k", "id AS v"), file_sink(tmp_path), table_job(partitionKeys="k")
    write_table(spread_rows(rows, ["k"]), sink, job, "completely")
    context = spark.sparkContext
    context.setJobGroup(f"opening {found}", "")
    try:
        back = read_back(spark, sink, job, rows)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for one in tracker.getJobIdsForGroup(f"opening {found}") for s in tracker.getJobInfo(one).stageIds]
    assert max(tracker.getStageInfo(stage).numTasks for stage in stages) <= 256
    assert back.rdd.getNumPartitions() <= 4
    relation = re.search(r"Relation \[(.*)\]", back._jdf.queryExecution().analyzed().toString())[1]
    assert ("k#" in relation) == (found == 20_000)
    assert back.where("k = v").count() == 300


def test_rebalancing_needs_adaptive_execution(spark, change):
    change("spark.sql.adaptive.enabled", "false")
    with pytest.raises(ValueError, match="adaptive"):
        spread_rows(keyed(spark, ("a", 1)), ["k"])
