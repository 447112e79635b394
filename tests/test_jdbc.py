from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from helpers import database, file_sink, plan_of, table_job
from sluice import Endpoint, conform, ingest_table, read_table
from sluice.functions.chars import _unpadded
from sluice.operators.filters import limit_filter
from sluice.operators.progress import highest_mark
from sluice.sources import highest_value
from sluice.sources.credentials import connection_properties
from sluice.sources.jdbc import check_endpoint, jdbc_options, jdbc_url
from sluice.sources.splits import (
    SplitColumn,
    balanced_ranges,
    both,
    counted_strides,
    even_cuts,
    even_groups,
    time_cuts,
)
from sluice_checks import derby

ORACLE = Endpoint(
    "ora",
    {
        "dbType": "oracle",
        "host": "ledger.example",
        "port": "1599",
        "dbName": "books",
        "driver": "oracle.jdbc.driver.OracleDriver",
        "batchSize": "500",
    },
)


def other(**options):
    return Endpoint("db", {"url": "jdbc:x:y", "dbType": "x", "driver": "a.Driver", **options})


def without(endpoint, option):
    return Endpoint("db", {k: v for k, v in endpoint.options.items() if k != option})


def rows_of(spark, source, mode="completely", as_of=None, **options):
    return read_table(spark, source, table_job(mode=mode, **options), mode, as_of)


def rows_per_partition(df):
    counts = df.groupBy(F.spark_partition_id().alias("p")).count().orderBy("p").collect()
    return [row["count"] for row in counts]


def test_url():
    assert jdbc_url(ORACLE) == "jdbc:oracle:thin:/@ledger.example:1599/books"
    assert jdbc_url(other(host="h", port="1", dbName="d")) == "jdbc:x:y"


@pytest.mark.parametrize("option", ["host", "port", "dbName"])
def test_url_needs_its_parts(option):
    with pytest.raises(ValueError, match=f"'{option}'"):
        jdbc_url(without(ORACLE, option))


def test_url_of_other_databases_must_be_given():
    with pytest.raises(ValueError, match="'url'"):
        jdbc_url(without(other(host="h", port="1", dbName="d"), "url"))
    with pytest.raises(ValueError, match="'dbType'"):
        jdbc_url(Endpoint("db", {"host": "h"}))


def test_driver_is_required():
    with pytest.raises(ValueError, match="'driver'"):
        check_endpoint(without(ORACLE, "driver"))


def test_oracle_options(spark):
    assert jdbc_options(spark, ORACLE, table_job()) == {
        "driver": "oracle.jdbc.driver.OracleDriver",
        "sessionInitStatement": (
            "BEGIN EXECUTE IMMEDIATE 'ALTER SESSION SET NLS_DATE_FORMAT = ''YYYY-MM-DD''';"
            " EXECUTE IMMEDIATE 'ALTER SESSION SET NLS_TIMESTAMP_FORMAT ="
            " ''YYYY-MM-DD HH24:MI:SS.FF6'''; END;"
        ),
        "oracle.jdbc.mapDateToTimestamp": "false",
        "preferTimestampNTZ": "false",
        "fetchsize": "500",
    }
    with pytest.raises(ValueError, match="preferTimestampNTZ must be false"):
        source = Endpoint("ora", ORACLE.options | {"preferTimestampNTZ": "true"})
        jdbc_options(spark, source, table_job())


def test_options_of_other_databases(spark):
    assert jdbc_options(spark, other(), table_job()) == {
        "driver": "a.Driver",
        "preferTimestampNTZ": "true",
        "fetchsize": "1000",
    }


def test_rows_per_round_trip(spark):
    assert jdbc_options(spark, ORACLE, table_job(batchSize="9"))["fetchsize"] == "9"


def test_credentials_are_optional(spark):
    assert connection_properties(spark, other()) == {}
    assert connection_properties(spark, other(user="u")) == {"user": "u"}
    given = other(user="u", password="p")
    assert connection_properties(spark, given) == {"user": "u", "password": "p"}
    with pytest.raises(ValueError, match="'user'"):
        connection_properties(spark, other(password="p"))


def test_password_from_a_credential_store(spark, tmp_path):
    jvm, path = spark._jvm, f"localjceks://file{tmp_path}/keys.jceks"
    conf = jvm.org.apache.hadoop.conf.Configuration(False)
    conf.set("hadoop.security.credential.provider.path", path)
    store = jvm.org.apache.hadoop.security.alias.CredentialProviderFactory.getProviders(conf).get(0)
    secret = spark._sc._gateway.new_array(jvm.char, 3)
    for i, character in enumerate("s3t"):
        secret[i] = character
    store.createCredentialEntry("the.alias", secret)
    store.flush()

    for option in ("passwordAlias", "alias"):
        source = other(user="u", credentialProviderPath=path, **{option: "the.alias"})
        assert connection_properties(spark, source) == {"user": "u", "password": "s3t"}
    with pytest.raises(ValueError, match="no password under the alias 'none'"):
        connection_properties(spark, other(user="u", credentialProviderPath=path, alias="none"))
    setting = "hadoop.security.credential.provider.path"
    assert spark._jsc.hadoopConfiguration().get(setting) is None


def test_filter_is_left_to_the_database(spark, sf_dir):
    source = derby.with_tables(spark, sf_dir, "orders")
    key = {"tableName": "orders", "checkColumn": "O_ORDERKEY", "lastValue": "7500"}
    df = rows_of(spark, source, "incrementally", **key)
    assert "*GreaterThanOrEqual(o_orderkey,7500)" in plan_of(df)
    day = {"tableName": "orders", "checkColumn": "o_orderdate"}
    df = rows_of(spark, source, "daily", "1998-06-16", **day)
    assert "*EqualTo(o_orderdate,1998-06-15T00:00)" in plan_of(df)
    picked = conform(df, StructType.fromDDL("o_orderkey int"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(picked)
    for plan in map(plan_of, (df, picked)):
        assert "Exchange" not in plan


def test_text_day_is_left_to_the_database(spark):
    rows = [(1, "2024-01-10"), (2, "not a day")]
    source, table = database(spark, rows, "id int, day string")
    df = rows_of(spark, source, "daily", "2024-01-11", tableName=table, checkColumn="day")
    assert "*EqualTo(day,2024-01-10)" in plan_of(df)
    assert [r.id for r in df.collect()] == [1]


CHARS = "day CHAR(12), short VARCHAR(12)"


@pytest.mark.parametrize("padding", ["true", "false"])
def test_char_columns(spark, tmp_path, change, padding):
    change("spark.sql.readSideCharPadding", padding)
    rows = [(1, "2024-01-10", "a"), (2, "2024-01-11", "b"), (3, "2024-01-12", "c")]
    source, table = database(spark, rows, "id int, day string, short string", types=CHARS)
    options = {"tableName": table, "checkColumn": "day"}
    daily = rows_of(spark, source, "daily", "2024-01-11", **options)
    assert "PushedFilters: [*IsNotNull(day), *EqualTo(day,2024-01-10)]" in plan_of(daily)
    assert [tuple(row) for row in daily.collect()] == [(1, "2024-01-10  ", "a")]
    newer = rows_of(spark, source, "incrementally", lastValue="2024-01-11", **options)
    assert "*GreaterThanOrEqual(day,2024-01-11)" in plan_of(newer)
    assert sorted(row.id for row in newer.collect()) == [2, 3]
    split = {"partitionColumn": "id", "numPartitions": "2", "balanceReads": "true"}
    newer = rows_of(spark, source, "incrementally", lastValue="2024-01-11", **options, **split)
    assert newer.rdd.getNumPartitions() == 2 and newer.count() == 2

    job = table_job(table, partitionKeys="short", rebalance="true")
    sink = file_sink(tmp_path)
    assert ingest_table(spark, job, source, sink, "completely").rows == 3
    back = spark.read.parquet(f"{tmp_path}/{table}")
    assert {field.name: field.metadata for field in back.schema}["day"] == {}
    assert spark.conf.get("spark.sql.readSideCharPadding") == padding


def test_the_session_without_padding_is_otherwise_the_same(spark, change):
    change("spark.sql.session.timeZone", "Asia/Tokyo")
    change("spark.sql.ansi.enabled", "false")
    settings, same = spark.conf.getAll, _unpadded(spark).conf.getAll
    padding = "spark.sql.readSideCharPadding"
    copied = {name for name in settings if spark.conf.isModifiable(name)} - {padding}
    assert len(copied) >= 2
    assert {name: same[name] for name in copied} == {name: settings[name] for name in copied}
    assert same[padding] == "false"


COMPARED = {
    "smallint": "3",
    "bigint": "3",
    "double": "2.5",
    "decimal(10,2)": "2.50",
    "date": "2024-01-02",
    "timestamp_ntz": "2024-01-02 03:04:05.123456",
    "string": "2",
    "boolean": "true",
}


@pytest.mark.parametrize("type_name", COMPARED)
def test_comparisons_of_every_type_are_left_to_the_database(spark, type_name):
    value = COMPARED[type_name]
    df = spark.range(1).select(F.lit(value).cast(type_name).alias("c"))
    source, table = derby.endpoint(spark, "tests"), f"typed_{type_name.split('(')[0]}"
    derby.fill(spark, source, table, df)
    for inclusive, rows in (("true", 1), ("false", 0)):
        options = {"checkColumn": "c", "lastValue": value, "inclusive": inclusive}
        newer = rows_of(spark, source, "incrementally", tableName=table, **options)
        assert "PushedFilters: [*IsNotNull(c), *GreaterThan" in plan_of(newer)
        assert "Filter (" not in plan_of(newer)
        assert newer.count() == rows


SPLIT = {"partitionColumn": "k", "lowerBound": "10", "upperBound": "20", "numPartitions": "4"}


def test_bounds_never_drop_rows(spark):
    rows = [(k,) for k in range(40)] + [(None,)] * 3
    source, table = database(spark, rows, "k int")
    df = rows_of(spark, source, tableName=table, **SPLIT)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 43 and df.filter("k IS NULL").count() == 3
    assert sorted(r.k for r in df.dropna().collect()) == list(range(40))


STARTS = {
    "int": (lambda i: i, "0", "100"),
    "bigint": (lambda i: i, "'0'", "'100'"),
    "decimal(10,2)": (Decimal, "0", "100"),
    "date": (lambda i: date(2024, 1, 1) + timedelta(i), "2024-01-01", "2024-04-10"),
    "timestamp_ntz": (
        lambda i: datetime(2024, 1, 1) + timedelta(i),
        "2024-01-01",
        "'2024-04-10 00:00:00'",
    ),
}


@pytest.mark.parametrize("keep_clock", ["true", "false"])
@pytest.mark.parametrize("type_name", STARTS)
def test_strides_start_where_the_mode_does(spark, change, type_name, keep_clock):
    change("spark.sql.session.timeZone", "Asia/Tokyo")
    value, lower, upper = STARTS[type_name]
    rows = [(value(i), i) for i in range(120)]
    columns = f"k {type_name}, id int"
    source, table = database(spark, rows, columns, preferTimestampNTZ=keep_clock)
    split = {"partitionColumn": "K", "lowerBound": lower, "upperBound": upper}
    options = {"tableName": table, "checkColumn": "k", "numPartitions": "4", **split}
    for last, counts in ((80, [5, 5, 5, 25]), (0, [25, 25, 25, 45]), (110, [10])):
        df = rows_of(spark, source, "incrementally", lastValue=str(value(last)), **options)
        assert rows_per_partition(df) == counts
        assert sorted(r.id for r in df.collect()) == list(range(last, 120))
        strict = {"lastValue": str(value(last)), "inclusive": "false", **options}
        df = rows_of(spark, source, "incrementally", **strict)
        assert sorted(r.id for r in df.collect()) == list(range(last + 1, 120))


def test_incomplete_split_reads_in_one_partition(spark):
    source, table = database(spark, [(1,)], "k int")
    options = {k: v for k, v in SPLIT.items() if k != "upperBound"}
    assert rows_of(spark, source, tableName=table, **options).rdd.getNumPartitions() == 1


def test_unusable_splits(spark):
    columns = "k int, s string, t timestamp_ntz, b boolean"
    source, table = database(spark, [(1, "x", datetime(2024, 1, 1), True)], columns)
    with pytest.raises(Exception, match="(?i)lower bound"):
        rows_of(spark, source, tableName=table, **SPLIT | {"lowerBound": "30"})
    with pytest.raises(ValueError, match="'s' should be a number, date or timestamp, not string; text needs"):
        rows_of(spark, source, tableName=table, **SPLIT | {"partitionColumn": "s"})
    for names in ("b", "k,b", "b,k"):
        with pytest.raises(ValueError, match="'b' should be a number"):
            balanced = {"numPartitions": "4", "balanceReads": "true", "partitionColumn": names}
            rows_of(spark, source, tableName=table, **balanced)
    with pytest.raises(ValueError, match="'nope' is not a column"):
        rows_of(spark, source, tableName=table, **SPLIT | {"partitionColumn": "nope"})
    with pytest.raises(ValueError, match="must be timestamps"):
        rows_of(spark, source, tableName=table, **SPLIT | {"partitionColumn": "t"})


TIMES = [(i, datetime(2024, 1, 1 + i, h)) for i in range(4) for h in (0, 12)] + [(9, None)]
TIME_SPLIT = {
    "partitionColumn": "T",
    "lowerBound": "'2024-01-02'",
    "upperBound": "'2024-01-04'",
    "numPartitions": "2",
}


@pytest.fixture
def sao_paulo(spark):
    zones = spark._jvm.java.util.TimeZone
    before = zones.getDefault()
    zones.setDefault(zones.getTimeZone("America/Sao_Paulo"))
    yield
    zones.setDefault(before)


def test_times_under_another_jvm_zone(spark, change, sao_paulo, tmp_path):
    change("spark.sql.session.timeZone", "Asia/Tokyo")
    source, table = database(spark, TIMES, "i int, t timestamp_ntz")
    assert jdbc_options(spark, source, table_job())["preferTimestampNTZ"] == "false"
    postgres = other(url="jdbc:postgresql://h")
    assert jdbc_options(spark, postgres, table_job())["preferTimestampNTZ"] == "true"
    wrong = Endpoint("db", source.options | {"preferTimestampNTZ": "true"})
    with pytest.raises(ValueError, match="would shift the times"):
        rows_of(spark, wrong, tableName=table)

    day = {"tableName": table, "checkColumn": "t"}
    for split in ({}, TIME_SPLIT, TIME_SPLIT | {"balanceReads": "true"}):
        whole = rows_of(spark, source, tableName=table, **split)
        assert whole.count() == len(TIMES)
        daily = rows_of(spark, source, "daily", "2024-01-03", **day, **split)
        assert [r.i for r in daily.collect()] == [1]
        within = rows_of(spark, source, "daily", "2024-01-03", wholeDay="true", **day, **split)
        assert [r.i for r in within.collect()] == [1, 1]
        last = {"lastValue": "2024-01-03 12:00:00"}
        later = rows_of(spark, source, "incrementally", **last, **day, **split)
        assert sorted(r.i for r in later.collect()) == [2, 3, 3]
    job = table_job(table, "incrementally", checkColumn="t", **last)
    result = ingest_table(spark, job, source, file_sink(tmp_path), "incrementally")
    assert (result.rows, result.last_value) == (3, "2024-01-05 00:00:00.000000+09:00")
    assert rows_of(spark, source, "incrementally", **day, lastValue=result.last_value, inclusive="false").isEmpty()


@pytest.mark.parametrize("keep_clock", ["true", "false"])
def test_times_do_not_depend_on_the_session_zone(spark, change, keep_clock):
    change("spark.sql.session.timeZone", "America/New_York")
    source, table = database(spark, TIMES, "i int, t timestamp_ntz", preferTimestampNTZ=keep_clock)
    whole = rows_of(spark, source, tableName=table, **TIME_SPLIT)
    assert rows_per_partition(whole) == [5, 4]
    day = {"tableName": table, "checkColumn": "t", **TIME_SPLIT}
    assert [r.i for r in rows_of(spark, source, "daily", "2024-01-03", **day).collect()] == [1]
    within = rows_of(spark, source, "daily", "2024-01-03", wholeDay="true", **day)
    assert [r.i for r in within.collect()] == [1, 1]
    later = rows_of(spark, source, "incrementally", lastValue="2024-01-03 12:00:00", **day)
    assert sorted(r.i for r in later.collect()) == [2, 3, 3]
    for names in ("t", "i,t", "t,i"):
        balanced = {"partitionColumn": names, "numPartitions": "3", "balanceReads": "true"}
        rows = rows_of(spark, source, tableName=table, **balanced)
        assert sorted(r.i for r in rows.collect()) == sorted(i for i, _ in TIMES)
        assert max(rows_per_partition(rows)) <= 5


def test_whole_days_of_dates(spark):
    rows = [(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)]
    source, table = database(spark, rows, "i int, d date")
    for whole_day in ("true", "false"):
        day = {"tableName": table, "checkColumn": "d", "wholeDay": whole_day}
        df = rows_of(spark, source, "daily", "2024-01-03", **day)
        assert [r.i for r in df.collect()] == [2]


@pytest.mark.parametrize("bounds", [{}, {"lowerBound": "0", "upperBound": "300"}])
def test_balanced_ranges(spark, bounds):
    day, time = date(2024, 1, 1), datetime(2024, 1, 1)
    rows = [(i * i, 0.5 * i if i % 50 else None, day, time) for i in range(400)]
    source, table = database(spark, rows, "k int, x double, d date, t timestamp_ntz")
    options = {"tableName": table, "numPartitions": "4", "balanceReads": "true"}
    even = rows_of(spark, source, partitionColumn="k", **options, **bounds)
    counts = rows_per_partition(even)
    assert sum(counts) == 400 and len(counts) == 4 and max(counts) <= 110
    gaps = rows_of(spark, source, partitionColumn="x", **options)
    assert gaps.count() == 400 and gaps.filter("x IS NULL").count() == 8
    for name in ("d", "t"):
        assert rows_of(spark, source, partitionColumn=name, **options).count() == 400


HOT_VALUES = {
    "number": (7, lambda i: i, "int"),
    "null": (None, lambda i: i, "int"),
    "day": (date(2024, 1, 5), lambda i: date(2024, 1, 1 + i % 28), "date"),
    "time": (datetime(2024, 1, 5), lambda i: datetime(2024, 1, 1 + i % 28), "timestamp_ntz"),
}


@pytest.mark.parametrize("kind", HOT_VALUES)
def test_a_hot_value_is_split_by_a_second_column(spark, kind):
    hot, other, type_name = HOT_VALUES[kind]
    rows = [(hot if i % 3 == 0 else other(i), i if i % 7 else None) for i in range(1200)]
    source, table = database(spark, rows, f"k {type_name}, id int")
    options = {"tableName": table, "numPartitions": "12", "balanceReads": "true"}

    alone = rows_per_partition(rows_of(spark, source, partitionColumn="k", **options))
    assert sum(alone) == 1200 and max(alone) >= 400
    df = rows_of(spark, source, partitionColumn="k, id", **options)
    assert max(rows_per_partition(df)) <= 250
    assert df.count() == 1200
    assert Counter(map(tuple, df.collect())) == Counter(rows)


@pytest.mark.parametrize(
    ("url", "type_name", "cut", "condition"),
    [
        ("jdbc:oracle:thin:@h", "date", date(2024, 1, 5), """"c" < {d '2024-01-05'}"""),
        (
            "jdbc:oracle:thin:@h",
            "timestamp",
            datetime(2024, 1, 5, 6, 7, 8, 90),
            """"c" < {ts '2024-01-05 06:07:08.00009'}""",
        ),
        ("jdbc:mysql://h", "timestamp_ntz", datetime(2024, 1, 5), "`c` < '2024-01-05 00:00:00'"),
        ("jdbc:postgresql://h", "date", date(2024, 1, 5), """"c" < '2024-01-05'"""),
        ("jdbc:postgresql://h", "bigint", 2**40, '"c" < 1099511627776'),
        ("jdbc:oracle:thin:@h", "decimal(38,0)", Decimal(10) ** 30, f'"c" < 1{"0" * 30}'),
    ],
)
def test_ranges_in_the_language_of_the_database(spark, url, type_name, cut, condition):
    field = StructType.fromDDL(f"c {type_name}")["c"]
    first, last = SplitColumn(spark, url, field).ranges([cut])
    assert first == condition + f" OR {condition.split(' ')[0]} IS NULL"
    assert last == condition.replace("<", ">=")


@given(
    st.lists(st.none() | st.integers(-5, 5), max_size=30),
    st.lists(st.none() | st.integers(-5, 5), min_size=30, max_size=30),
    st.sets(st.integers(-6, 6), max_size=5),
    st.sets(st.integers(-6, 6), min_size=1, max_size=5),
    st.booleans(),
)
@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
def test_every_row_meets_one_condition(spark, first, second, cuts, inner_cuts, nulls_apart):
    schema = StructType.fromDDL("a int, b int")
    a, b = (SplitColumn(spark, "jdbc:postgresql://h", field) for field in schema)
    outer = a.ranges(sorted(cuts), nulls_apart)
    if outer is None:
        assert not cuts and not nulls_apart
        return
    conditions = [*both(outer[:1], b.ranges(sorted(inner_cuts))), *outer[1:]]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE t (a INT, b INT)")
    if first:
        duck.executemany("INSERT INTO t VALUES (?, ?)", list(zip(first, second)))
    hits = " + ".join(f"(({condition}) IS TRUE)::INT" for condition in conditions)
    assert duck.sql(f"SELECT COUNT(*) FROM t WHERE {hits} <> 1").fetchall() == [(0,)]


@pytest.mark.parametrize("parts", [100, 300])
def test_many_balanced_ranges(spark, parts):
    """Cuts of a skewed column, found in two levels; a third of the rows has one value."""
    value = F.when(F.col("id") % 3 == 0, 5_000_000).otherwise((F.col("id") * F.col("id")) % 10_000_019)
    df = spark.range(0, 300_000, 1, 8).select(value.alias("k"), "id")
    columns = [SplitColumn(spark, "jdbc:x:y", df.schema[name]) for name in ("k", "id")]

    def load(conditions):
        if conditions is None:
            return df
        which = F.lit(0)
        for i, condition in reversed(list(enumerate(conditions))):
            which = F.when(F.expr(condition.replace('"', "`")), i).otherwise(which)
        # A partition for each condition, as the reader has them.
        rows = df.withColumn("part", which).repartitionByRange(len(conditions), "part")
        return rows if len(conditions) < 3 else spread(rows, len(conditions))

    def spread(rows, n):
        keyed = rows.rdd.map(lambda r: (r.part, (r.k, r.id))).partitionBy(n, int).values()
        return spark.createDataFrame(keyed, "k long, id long")

    ranges = balanced_ranges(columns[:1], parts, load, (0, 10_000_019))
    assert 0.5 * parts <= len(ranges) <= 1.2 * parts
    duck = duckdb.connect()
    table = df.toPandas()
    duck.register("t", table)
    counts = [duck.sql(f"SELECT count(*) FROM t WHERE {c}").fetchall()[0][0] for c in ranges]
    counts.sort()
    assert sum(counts) == 300_000 and counts[-1] >= 100_000  # the one value, whole
    assert counts[-2] <= 1.6 * 300_000 / parts


def test_nothing_to_split_by(spark):
    source, table = database(spark, [(None, 1), (None, 2), (None, None)], "k int, id int")
    options = {"tableName": table, "numPartitions": "4", "balanceReads": "true"}
    for names in ("k", "k,id", "id,k"):
        assert rows_of(spark, source, partitionColumn=names, **options).count() == 3


@pytest.mark.parametrize("value", ["NaN", "Infinity"])
def test_cuts_are_finite(spark, value):
    df = spark.range(10).select(F.lit(value).cast("double").alias("k"))
    column = SplitColumn(spark, "jdbc:x:y", df.schema["k"])
    assert balanced_ranges([column], 4, lambda found: df, (float(value), float(value))) is None


def test_balanced_reads_look_at_one_column_in_parallel(spark, monkeypatch):
    source, table = database(spark, [(i, i % 3, "x") for i in range(90)], "id int, k int, s string")
    looked = []

    def spy(columns, parts, load, bounds, count):
        looked.append(tuple(bounds))
        return balanced_ranges(columns, parts, lambda c: looked.append(c) or load(c), bounds, count)

    monkeypatch.setattr("sluice.sources.jdbc.balanced_ranges", spy)
    options = {"tableName": table, "numPartitions": "6", "balanceReads": "true"}
    df = rows_of(spark, source, partitionColumn="k,id", **options)
    assert Counter(r.k for r in df.collect()) == {0: 30, 1: 30, 2: 30}
    assert looked[0] == (0, 89)
    assert len(looked[1]) == 6 and all('"id"' in c and '"k"' not in c for c in looked[1])
    assert all('"id"' in c and '"k"' in c for c in looked[2])


def test_balanced_ranges_of_the_selected_rows(spark):
    source, table = database(spark, [(k,) for k in range(1000)], "k int")
    options = {"tableName": table, "numPartitions": "4", "balanceReads": "true"}
    newer = {"checkColumn": "k", "lastValue": "900", "partitionColumn": "k"}
    df = rows_of(spark, source, "incrementally", **newer, **options)
    assert max(rows_per_partition(df)) <= 28 and df.count() == 100


BOUNDS = {
    "int": (lambda i: i, "incrementally", "80", (80, 89)),
    "date": (lambda i: date(2024, 1, 1) + timedelta(i), "daily", None, None),
    "timestamp_ntz": (lambda i: datetime(2024, 1, 1) + timedelta(i), "daily", None, None),
}


@pytest.mark.parametrize("type_name", BOUNDS)
@pytest.mark.parametrize("keep_clock", ["true", "false"])
def test_balanced_reads_start_where_the_mode_does(
    spark, change, monkeypatch, type_name, keep_clock
):
    change("spark.sql.session.timeZone", "Asia/Tokyo")
    value, mode, last, bounds = BOUNDS[type_name]
    rows = [(value(i), i) for i in range(90)]
    bounds = bounds or (value(10), value(89))
    columns = f"k {type_name}, id int"
    source, table = database(spark, rows, columns, preferTimestampNTZ=keep_clock)
    looked = []

    def spy(columns, parts, load, bounds, count):
        looked.append(tuple(bounds))
        return balanced_ranges(columns, parts, load, bounds, count)

    monkeypatch.setattr("sluice.sources.jdbc.balanced_ranges", spy)
    options = {"tableName": table, "numPartitions": "4", "balanceReads": "true"}
    options |= {"checkColumn": "K", "partitionColumn": "k"} | ({"lastValue": last} if last else {})
    df = rows_of(spark, source, mode, "2024-01-12", **options)
    assert looked == [bounds]
    assert sorted(r.id for r in df.collect()) == (list(range(80, 90)) if last else [10])


def test_balanced_read_of_an_empty_table(spark):
    source, table = database(spark, [], "k int")
    options = {"tableName": table, "numPartitions": "4", "balanceReads": "true"}
    assert rows_of(spark, source, partitionColumn="k", **options).count() == 0


@given(
    st.datetimes(datetime(1990, 1, 1), datetime(2040, 1, 1)),
    st.datetimes(datetime(1990, 1, 1), datetime(2040, 1, 1)),
    st.integers(1, 50),
)
def test_time_cuts(a, b, parts):
    lower, upper = sorted((a, b))
    cuts = time_cuts(lower.isoformat(), upper.isoformat(" "), parts)
    assert cuts == sorted(set(cuts)) and len(cuts) <= parts - 1
    assert all(lower <= cut <= upper for cut in cuts)


def test_even_cuts():
    assert even_cuts(0, 10, 4) == [2, 5, 7]
    assert even_cuts(5, 5, 4) == [5]
    assert even_cuts(0.0, 1.0, 2) == [0.5]
    assert even_cuts(Decimal("1.0"), Decimal("2.0"), 2) == [Decimal("1.5")]
    assert even_cuts(date(2024, 1, 1), date(2024, 1, 4), 2) == [date(2024, 1, 2)]
    assert even_cuts(0, 1, 1) == []


@given(st.data(), st.integers(1, 60))
def test_even_cuts_lie_between_the_bounds(data, parts):
    kinds = [st.integers(-(10**18), 10**18), st.dates(), st.decimals(-1000, 1000, places=2)]
    kind = data.draw(st.sampled_from(kinds))
    low, high = sorted((data.draw(kind), data.draw(kind)))
    cuts = even_cuts(low, high, parts)
    assert cuts == sorted(set(cuts)) and len(cuts) <= parts - 1
    assert all(low <= cut <= high for cut in cuts)


def test_time_cuts_are_strides_of_equal_width():
    days = [datetime(2021, 3, 7), datetime(2021, 3, 9)]
    assert time_cuts("2021-03-05", "2021-03-11", 3) == days
    assert time_cuts("2021-03-05", "2021-03-11", 1) == []
    with pytest.raises(ValueError, match="behind"):
        time_cuts("2021-03-11", "2021-03-05", 3)
    with pytest.raises(ValueError, match="zone"):
        time_cuts("2021-03-05 00:00:00+02:00", "2021-03-11 00:00:00+02:00", 3)


def test_the_embedded_database_is_refused_on_a_cluster():
    class Cluster:
        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(RuntimeError, match="one process only"):
        derby.require_local(Cluster)


# Strides counted by the database


SKEWED = {
    "double": lambda x: x,
    "bigint": lambda x: int(x),
    "decimal(20,3)": lambda x: Decimal(f"{x:.3f}"),
    "timestamp_ntz": lambda x: datetime(2000, 1, 1) + timedelta(seconds=x),
    "date": lambda x: date(1900, 1, 1) + timedelta(days=min(int(x), 40_000)),
}


@pytest.mark.parametrize("type_name", SKEWED)
def test_the_first_pass_is_even_on_a_skewed_column(spark, monkeypatch, type_name):
    rng = random.Random(7)
    values = [SKEWED[type_name](rng.lognormvariate(6, 2.5)) for _ in range(4000)] + [None] * 3
    source, table = database(spark, list(enumerate(values)), f"id int, v {type_name}")
    passes = []

    def spy(columns, parts, load, bounds, count):
        def seen(conditions):
            passes.append(rows_per_partition(load(conditions)))
            return load(conditions)

        return balanced_ranges(columns, parts, seen, bounds, count)

    monkeypatch.setattr("sluice.sources.jdbc.balanced_ranges", spy)
    options = {"tableName": table, "numPartitions": "16", "balanceReads": "true"}
    df = rows_of(spark, source, partitionColumn="v", **options)
    hottest = max(Counter(v for v in values if v is not None).values())
    assert max(passes[0]) <= max(2 * 4003 / 16, hottest) + 3 and len(passes[0]) <= 16
    assert sorted(r.id for r in df.collect()) == list(range(4003))
    assert max(rows_per_partition(df)) <= max(1.3 * 4003 / 16, hottest + 4003 / 16)


@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 12))
def test_even_groups(counts, parts):
    strides = [(i, n) for i, n in enumerate(counts)]
    if not sum(counts):
        return
    cuts = even_groups(strides, parts)
    assert len(cuts) < parts
    assert cuts == sorted(set(cuts)) and 0 not in cuts
    edges = [0, *cuts, len(counts)]
    share = sum(counts) / parts
    assert all(sum(counts[a:b]) <= share + max(counts) for a, b in zip(edges, edges[1:]))


def test_strides_are_cut_until_they_are_even_or_cannot_be(spark):
    values = sorted([0] * 50 + [int(1.3**i) for i in range(60)])
    column = SplitColumn(spark, "jdbc:derby:memory:x", StructField("v", LongType()))
    asked = []

    def count(strides):
        asked.append(len(strides))
        return [sum(a <= v and (b is None or v < b) for v in values) for a, b in strides]

    found = counted_strides(column, values[0], values[-1], 10, count)
    assert sum(n for _, n in found) == len(values) and found[0] == (0, 50)
    assert all(n <= 11 for start, n in found[1:])
    assert len(asked) < 10 and max(asked) <= 64 + 160


# Text


NAMES = ["", "'", "a", "A", "aa", "b'c", "é", "z", "Z", "漢字", "a b", "ab\u0301", "ÿ"]


@pytest.mark.parametrize("names", ["k", "k,id", "n,k"])
@pytest.mark.parametrize("shared", ["", "customer#", "größe"])
def test_balanced_reads_of_text(spark, shared, names):
    rng = random.Random(3)
    texts = [shared + rng.choice(NAMES) + str(rng.randint(0, 999)) for _ in range(600)]
    texts += [f"{shared}hot"] * 300
    rows = [(i, t, i % 2) for i, t in enumerate(texts)]
    source, table = database(spark, rows, "id int, k string, n int")
    options = {"tableName": table, "numPartitions": "6", "balanceReads": "true", "partitionColumn": names}
    df = rows_of(spark, source, **options)
    assert sorted(r.id for r in df.collect()) == list(range(len(rows)))
    assert 4 <= len(rows_per_partition(df)) <= 14
    most = {"k": 300 + 300, "k,id": 300, "n,k": 300 + 2 * len(rows) / 6}[names]
    assert max(rows_per_partition(df)) <= most


def test_text_in_another_order_is_refused(spark):
    """A database that sorts letters as a dictionary does."""
    source = derby.endpoint(spark, "dictionary")
    url = source.require("url") + ";territory=de_DE;collation=TERRITORY_BASED"
    source = Endpoint("dictionary", source.options | {"url": url})
    words = [f"{w}{i}" for i in range(40) for w in ("apfel", "Apfel", "Birne", "birne", "Ähre", "Zebra", "zebra")]
    derby.fill(spark, source, "words", spark.createDataFrame(list(enumerate(words)), "id int, w string"))
    options = {"tableName": "words", "numPartitions": "6", "balanceReads": "true"}
    with pytest.raises(ValueError, match="does not sort"):
        rows_of(spark, source, partitionColumn="w", **options)
    df = rows_of(spark, source, partitionColumn="id", **options)
    assert df.count() == len(words)


# Marks of a database


def test_a_database_says_its_highest_mark_itself(spark, monkeypatch):
    source, table = database(spark, [(i, f"k{i}") for i in range(50)], "id int, s string")
    job = table_job(table, "incrementally", checkColumn="ID", lastValue="20")
    rows = read_table(spark, source, job, "incrementally")
    read = []
    monkeypatch.setattr("sluice.sources.highest_mark", lambda df, check: read.append(df) or highest_mark(df, check))
    assert highest_value(spark, source, job, "incrementally", rows) == "49"
    assert "MAX" in plan_of(read[0]) and read[0].count() == 1
    later = table_job(table, "incrementally", checkColumn="ID", lastValue="49", inclusive="false")
    assert highest_value(spark, source, later, "incrementally", rows) is None
    text = table_job(table, "incrementally", checkColumn="s", lastValue="''")
    assert highest_value(spark, source, text, "incrementally", rows) == "'k9'"


def test_rows_with_nan_are_copied_by_each_run(spark):
    nan = float("nan")
    for values, limit, kept in [([1.0, nan, 3.0], "3.0", 3), ([1.0, nan, 3.0], "1.0", 2), ([nan, nan], None, 2)]:
        for kind in ("double", "float"):
            df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
            assert limit_filter(df, "v", limit).count() == kept
