"""Conditions that split a table into ranges for a parallel read.

Together they always select every row exactly once, whatever the cut points are: these only
decide how even the parts become. Spark reads each condition in a task of its own.
"""

from __future__ import annotations

import math
import os
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable
from datetime import datetime
from itertools import chain, pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    StructField,
    TimestampNTZType,
    TimestampType,
)

from sluice.functions.columns import column

# Size of the sketches by which cuts are estimated, whatever the number of ranges: some hundred
# kilobytes each, right to less than a thousandth of the rows.
SKETCH = 4096

# Strides that the database counts first, for each range wanted and at most, and into how many a heavy one is cut.
STRIDES, MOST_STRIDES, FINER = 4, 64, 16

# How often heavy strides are cut and counted again.
ROUNDS = 8

# Conditions that are put into one question to the database.
AT_ONCE = 200

# Bytes of a text behind what all texts share, of which a whole number is made.
TEXT_BYTES = 7

# Cuts taken from one sketch of all rows, about the finest that it can tell. Finer ones come from a
# sketch for each range between these.
COARSE = 64


def clock_zone(spark: SparkSession) -> str:
    """The zone in which JDBC drivers turn a clock time into an instant: the JVM's.

    Executors must have the same one as the driver, whose literals they are compared with.
    """
    return spark._jvm.java.util.TimeZone.getDefault().getID()


def quoted_name(spark: SparkSession, url: str, name: str) -> str:
    """A column's name as the SQL of the database at a URL has it."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)


class SplitColumn:
    """A column to split by, in Spark and in the SQL of the database at a URL."""

    def __init__(self, spark: SparkSession, url: str, field: StructField, text: bool = False):
        kinds = (NumericType, DateType, TimestampType, TimestampNTZType) + (StringType,) * text
        if not isinstance(field.dataType, kinds):
            hint = "; text needs balanceReads" if isinstance(field.dataType, StringType) else ""
            raise ValueError(
                f"partitionColumn '{field.name}' should be a number, date or timestamp,"
                f" not {field.dataType.simpleString()}{hint}"
            )
        self._spark, self._field, self._shared = spark, field, b""
        self.used: set = set()  # all cuts of its ranges
        self._dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        self.name = quoted_name(spark, url, field.name)

    @property
    def values(self) -> Column:
        return column(self._field.name)

    @property
    def is_null(self) -> str:
        return f"{self.name} IS NULL"

    def ranges(self, cuts: list, nulls_apart: bool = False) -> list[str] | None:
        """One condition per range between the cuts; NULLs belong to the first or get their own."""
        self.used.update(cuts)
        if not cuts:
            return [self.is_null, f"{self.name} IS NOT NULL"] if nulls_apart else None
        limits = [self._literal(cut) for cut in cuts]
        first, last = f"{self.name} < {limits[0]}", f"{self.name} >= {limits[-1]}"
        inner = [f"{self.name} >= {a} AND {self.name} < {b}" for a, b in pairwise(limits)]
        if nulls_apart:
            return [self.is_null, first, *inner, last]
        return [f"{first} OR {self.is_null}", *inner, last]

    @property
    def is_text(self) -> bool:
        return isinstance(self._field.dataType, StringType)

    def between(self, low: str | None, high: str | None) -> None:
        """Says where the texts of a column lie: what these two share at the front tells none apart."""
        self._shared = os.path.commonprefix([(low or "").encode(), (high or "").encode()])

    def cuts_between(self, low, high, parts: int) -> list:
        """The inner limits of ``parts`` ranges of equal width."""
        if not self.is_text:
            return even_cuts(low, high, parts)
        numbers = [self._number_of(text) for text in (low, high)]
        return sorted(set(map(self._text_of, even_cuts(*numbers, parts))))

    def known(self, cuts: Iterable | None) -> list:
        """Cuts that Spark has found, as values of the column."""
        found = _finite(cuts)
        return [self._text_of(number) for number in found] if self.is_text else found

    def _number_of(self, text: str) -> int:
        rest = text.encode()[len(self._shared) :][:TEXT_BYTES]
        return int.from_bytes(rest.ljust(TEXT_BYTES, b"\0"))

    def _text_of(self, number: int) -> str:
        raw = (self._shared + number.to_bytes(TEXT_BYTES)).rstrip(b"\0")
        return raw.decode(errors="ignore")  # a letter may be cut

    def histogram_of(self, table: str, strides: list[tuple]) -> str:
        """A query by which the database counts the rows in each of some strides, from the first value
        of each to before the second: a row for each that has rows."""
        cases, wanted = [], []
        for number, (low, high) in enumerate(strides):
            inside = f"{self.name} >= {self._literal(low)}"
            if high is not None:
                inside += f" AND {self.name} < {self._literal(high)}"
            cases.append(f"WHEN {inside} THEN {number}")
            wanted.append(f"({inside})")
        part = f"CASE {' '.join(cases)} END AS part"
        rows = f"SELECT {part} FROM {table} WHERE {' OR '.join(wanted)}"
        return f"(SELECT part, COUNT(*) AS n FROM ({rows}) strides GROUP BY part) counted"

    def disorder_of(self, table: str, cuts: list) -> str:
        """A query by which the database counts the rows that are before a cut and behind a later one:
        none, if it sorts as the cuts are sorted."""
        limits = [self._literal(cut) for cut in cuts]
        wrong = [f"({self.name} < {a} AND {self.name} >= {b})" for a, b in pairwise(limits)]
        return f"(SELECT COUNT(*) AS n FROM {table} WHERE {' OR '.join(wrong)}) disorder"

    def bounds_of(self, table: str) -> str:
        """A query by which the database finds the lowest and highest value: one row."""
        return f"(SELECT MIN({self.name}) AS low, MAX({self.name}) AS high FROM {table}) bounds"

    def as_bounds(self, low: Column, high: Column) -> list[Column]:
        """Bounds found by the database as Spark's reader takes them: text, whole numbers."""
        if isinstance(self._field.dataType, NumericType):
            whole = (F.floor(low), F.ceil(high))
            return [value.try_cast("bigint").cast("string") for value in whole]
        return [self.on_clock(value).cast("string") for value in (low, high)]

    def raised(self, lower: str, upper: str, start: Column) -> str:
        """``lower``, or ``start`` where that lies between the bounds.

        No row to ingest comes before ``start``; strides below it would all be empty.
        """
        dtype = self._field.dataType
        kind = "bigint" if isinstance(dtype, NumericType) else "timestamp_ntz"
        if isinstance(dtype, NumericType):
            start = F.floor(start)
        low, high, begin = (
            c.try_cast(kind) for c in (F.lit(lower), F.lit(upper), self.on_clock(start))
        )
        text = begin.cast("date" if isinstance(dtype, DateType) else kind).cast("string")
        # One literal row: the optimizer works this out by itself, no job runs.
        row = self._spark.sql("SELECT * FROM VALUES (1) AS one(row)")
        return row.select(F.when((begin > low) & (begin < high), text)).collect()[0][0] or lower

    def sketch(self) -> Column:
        """A summary of the values, of bounded size, for ``quantiles``."""
        if self._is_whole:
            return F.kll_sketch_agg_bigint(self._as_number(), F.lit(SKETCH))
        value = self._as_number()
        finite = F.abs(value) < F.lit(math.inf)  # neither infinite nor NaN
        return F.kll_sketch_agg_double(F.when(finite, value), F.lit(SKETCH))

    def quantiles(self, sketch: str, parts: int) -> Column:
        """The values that cut the rows into equal parts; a frequent one comes repeatedly. NULL
        if there is none."""
        kind = "bigint" if self._is_whole else "double"
        number = F.call_function(f"kll_sketch_get_n_{kind}", F.col(sketch))
        shares = F.lit([i / parts for i in range(1, parts)])
        cuts = F.call_function(f"kll_sketch_get_quantile_{kind}", F.col(sketch), shares)
        return F.when(number > 0, F.transform(cuts, self._from_number))

    @property
    def _is_whole(self) -> bool:
        return not isinstance(self._field.dataType, (DecimalType, DoubleType, FloatType))

    def _as_number(self) -> Column:
        """The value as a whole number or a double: days for dates, microseconds for times."""
        dtype, value = self._field.dataType, self.values
        if self.is_text:
            part = F.substring(value.cast("binary"), len(self._shared) + 1, TEXT_BYTES)
            padded = F.rpad(part, TEXT_BYTES, F.lit(b"\0"))
            return F.conv(F.hex(padded), 16, 10).cast("bigint")
        if isinstance(dtype, DateType):
            return F.unix_date(value).cast("bigint")
        if isinstance(dtype, TimestampType):
            return F.unix_micros(value)
        if isinstance(dtype, TimestampNTZType):
            seconds = F.hour(value) * 3600 + F.minute(value) * 60 + F.extract(F.lit("SECOND"), value)
            day = F.unix_date(value.cast("date")).cast("bigint")
            return day * 86_400_000_000 + (seconds * 1_000_000).cast("bigint")
        return value.cast("bigint" if self._is_whole else "double")

    def _from_number(self, number: Column) -> Column:
        dtype = self._field.dataType
        if self.is_text:  # ``known`` does it
            return number
        if isinstance(dtype, DateType):
            return F.date_from_unix_date(number.cast("int"))
        if isinstance(dtype, TimestampType):
            return self.on_clock(F.timestamp_micros(number))
        if isinstance(dtype, TimestampNTZType):
            # Whole days and the rest apart: the clock has no zone.
            day = F.floor(number / F.lit(86_400_000_000)).cast("int")
            rest = (number - day.cast("bigint") * 86_400_000_000).cast("decimal(18,6)") / 1_000_000
            since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))
            return F.date_from_unix_date(day).cast("timestamp_ntz") + since
        return number.cast(dtype)

    def on_clock(self, value: Column) -> Column:
        """An instant as the database's clock shows it, which is what its SQL compares."""
        if not self._is_instant:
            return value
        zone = F.lit(clock_zone(self._spark))
        return F.convert_timezone(None, zone, value.cast("timestamp_ntz"))

    @property
    def _is_instant(self) -> bool:
        return isinstance(self._field.dataType, TimestampType)

    def _literal(self, value: object) -> str:
        return str(self._dialect.compileValue(_jvm_value(self._spark, value, self._field.dataType)))


def _jvm_value(spark: SparkSession, value: object, dtype: DataType) -> object:
    """The Java object from which Spark's JDBC dialects make a literal."""
    java = spark._jvm.java
    if isinstance(dtype, TimestampNTZType):
        return java.time.LocalDateTime.parse(value.isoformat())
    if isinstance(dtype, TimestampType):
        return java.sql.Timestamp.valueOf(value.isoformat(sep=" "))
    if isinstance(dtype, DateType):
        return java.sql.Date.valueOf(value.isoformat())
    return value


def time_cuts(lower: str, upper: str, parts: int) -> list[datetime]:
    """``even_cuts`` between two timestamps given as text."""
    try:
        start, end = datetime.fromisoformat(lower), datetime.fromisoformat(upper)
    except ValueError as error:
        raise ValueError(f"the bounds of a timestamp column must be timestamps: {error}") from None
    if start.tzinfo or end.tzinfo:
        raise ValueError("the bounds of a column without zone cannot have one")
    if start > end:
        raise ValueError(f"lowerBound '{lower}' is behind upperBound '{upper}'")
    return even_cuts(start, end, parts)


def even_cuts(low, high, parts: int) -> list:
    """The inner limits of ``parts`` ranges of equal width, for numbers, dates and timestamps."""
    steps = [(high - low) * i for i in range(1, parts)]
    if isinstance(low, int):
        return sorted({low + step // parts for step in steps})
    return sorted({low + step / parts for step in steps})


def balanced_ranges(
    columns: list[SplitColumn],
    parts: int,
    load: Callable[[list[str] | None], DataFrame],
    bounds: tuple,
    count: Callable[[list[tuple]], list[int]] | None = None,
) -> list[str] | None:
    """Ranges of the first column with about as many rows in each.

    A value that alone fills several ranges, NULL included, is split further by the second
    column, if there is one. ``load`` reads the rows that meet each of some conditions, one
    partition per condition. What is read is just the column in question, in even strides
    between the ``bounds`` of the last column, or in strides of about as many rows where ``count``
    has the database count those, and summarised within each partition by a sketch of bounded size. All sketches meet for a few coarse cuts; finer ones take a second pass, in
    strides between the coarse cuts, whose sketches meet by range. What reaches the driver is
    about one cut per range.
    """
    if parts == 1:
        return None
    first, last = columns[0], columns[-1]
    known = _finite(bounds)
    counted = counted_strides(last, *known, parts, count) if count and len(known) == 2 else None

    def strides(number: int) -> list[str] | None:
        if counted is not None:
            return last.ranges(even_groups(counted, number))
        return last.ranges(last.cuts_between(*known, number)) if len(known) == 2 else None

    coarse = min(parts, COARSE)
    seen = (
        load(strides(parts))
        .agg(
            first.sketch().alias("sketch"),
            F.count(F.lit(1)).alias("rows"),
            F.count(first.values).alias("known"),
        )
        .select(first.quantiles("sketch", coarse).alias("cuts"), "rows", "known")
        .first()
    )
    cuts = Counter(first.known(seen.cuts))
    if parts > coarse and cuts:
        cuts = _finer(first, cuts, -(-parts // coarse), load)
    null_shares = (seen.rows - seen.known) * parts // max(seen.rows, 1)
    ranges = first.ranges(sorted(cuts), nulls_apart=null_shares > 1)
    if not ranges or len(columns) == 1:
        return ranges

    # How many even parts each range is worth: it starts with its cut, and a cut found several
    # times is a value with that many parts.
    shares = [null_shares] if null_shares > 1 else []
    shares += [1, *(cuts[cut] for cut in sorted(cuts))]
    hot = [i for i, share in enumerate(shares) if share > 1]
    if not hot:
        return ranges
    pieces = [(i, one) for i in hot for one in both([ranges[i]], strides(shares[i]))]
    owners, most = F.lit([i for i, _ in pieces]), max(shares)
    share = F.element_at(F.lit(shares), F.col("range") + 1)
    found = (
        load([condition for _, condition in pieces])
        .groupBy(F.element_at(owners, F.spark_partition_id() + 1).alias("range"))
        .agg(last.sketch().alias("sketch"))
        .select("range", last.quantiles("sketch", most).alias("cuts"))
        # Of evenly spaced cuts those that the range needs: as many as it is worth.
        .select(
            "range",
            F.transform(
                F.sequence(F.lit(1), share - 1),
                lambda i: F.element_at("cuts", F.floor(i * most / share).cast("int")),
            ).alias("cuts"),
        )
        .collect()
    )
    inner = {row.range: sorted(set(last.known(row.cuts))) for row in found}
    split = [both([condition], last.ranges(inner.get(i, []))) for i, condition in enumerate(ranges)]
    return list(chain(*split))


def _finer(first: SplitColumn, coarse: Counter, pieces: int, load: Callable) -> Counter:
    """Cuts of ``pieces`` parts in each range between coarse cuts, those included."""
    limits = sorted(coarse)
    steps = [low_high for low_high in pairwise(limits)]
    reading = sorted({*limits, *chain(*[first.cuts_between(low, high, pieces) for low, high in steps])})
    # The range between limits in which each partition lies; the first partition is below all.
    owners = [0, *[bisect_right(limits, cut) for cut in reading]]
    found = (
        load(first.ranges(reading))
        .groupBy(F.element_at(F.lit(owners), F.spark_partition_id() + 1).alias("range"))
        .agg(first.sketch().alias("sketch"))
        .select(first.quantiles("sketch", pieces).alias("cuts"))
        .collect()
    )
    cuts = Counter(chain(*[first.known(row.cuts) for row in found]))
    for cut, times in coarse.items():
        # A value that is several coarse cuts fills the ranges between them.
        cuts[cut] += 1 + (times - 1) * pieces
    return cuts


def counted_strides(
    column: SplitColumn, low, high, parts: int, count: Callable[[list[tuple]], list[int]]
) -> list[tuple]:
    """Strides from ``low`` on as (start, rows), none with over a ``parts``-th of the rows unless it
    cannot be cut any further. The last one is open.

    Even strides are counted, and the heavy ones among them cut and counted again, so a few short answers tell
    how the rows lie.
    """
    starts = [low, *[cut for cut in column.cuts_between(low, high, min(STRIDES * parts, MOST_STRIDES)) if cut > low]]
    strides = list(zip(starts, [*starts[1:], None]))
    rows = dict(zip(strides, count(strides)))
    most = max(1, sum(rows.values()) // parts)
    whole: set[tuple] = set()  # strides that cannot be cut
    for _ in range(ROUNDS):
        finer = []
        for start, end in [stride for stride, n in rows.items() if n > most and stride not in whole]:
            inner = [c for c in column.cuts_between(start, end or high, FINER) if c > start and (end is None or c < end)]
            if not inner:
                whole.add((start, end))
                continue
            del rows[start, end]
            limits = [start, *inner, end]
            finer += list(pairwise(limits))
        if not finer:
            break
        rows |= dict(zip(finer, count(finer)))
    return sorted((start, n) for (start, _), n in rows.items())


def even_groups(strides: list[tuple], parts: int) -> list:
    """Cuts that put strides together into at most ``parts`` ranges with about as many rows."""
    share = sum(n for _, n in strides) / parts
    before, target, cuts = 0, share, []
    for start, n in strides:
        # A share that ends within a stride ends at its nearer end.
        if before and before + n / 2 >= target and len(cuts) < parts - 1:
            cuts.append(start)
            target = share * (math.floor((before + n / 2) / share) + 1)
        before += n
    return cuts


def both(conditions: list[str], others: list[str] | None) -> list[str]:
    """Each of the conditions together with each of the others, if there are any."""
    if not others:
        return conditions
    return [f"({one}) AND ({other})" for one in conditions for other in others]


def _finite(cuts: Iterable | None) -> list:
    known = [c for c in cuts or [] if c is not None]
    return [c for c in known if not (isinstance(c, float) and not math.isfinite(c))]
