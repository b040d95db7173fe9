"""Consecutive numbers and exact first-n over a total order, without a one-partition window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.plans.workspace import written

# Rows that one ordered-limit task should merge, the first n of every partition; beyond it rows are numbered in parallel.
ORDERED_LIMIT_ROWS = 1_000_000
_ROW_BITS = 33
# Buckets of a histogram over numbers, and characters by which one over texts goes on.
_BUCKETS = 4096
_CHARACTERS = 2


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, … in the given order, over all rows.

    A range-partitioned sort gives every task a contiguous stretch of the order. Row ids carry the
    partition number in their high bits, so one running sum over the per-partition row counts (as many
    rows as there are sort tasks) turns them into global positions. The sorted rows are written first,
    which freezes the partition boundaries.
    """
    ordered = df.orderBy(*order).withColumn("_rid", F.monotonically_increasing_id())
    fixed = written(ordered, f"numbered-{name}")
    part = F.shiftright("_rid", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        fixed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_rid").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_part", "_offset", "_rid")
    )


def fits_one_task(df: DataFrame, n: int) -> bool:
    """Whether the first ``n`` rows of every partition are few enough for one task.

    The number of partitions is taken from the session, which sizes it to its data.
    """
    spark = df.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return n * partitions <= ORDERED_LIMIT_ROWS


def _number(name: str, kind: T.DataType) -> Column:
    return (F.unix_date(name) if isinstance(kind, T.DateType) else F.col(name)).cast("double")


@dataclass
class _Buckets:
    """A histogram's buckets over one column: equal widths between two numbers, or the first characters of a text."""

    name: str
    kind: T.DataType
    low: float = 0.0
    high: float = 0.0
    length: int = 0

    @classmethod
    def first(cls, df: DataFrame, name: str) -> _Buckets | None:
        """Where narrowing begins; None if the type has no buckets."""
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            return cls(name, kind, length=_CHARACTERS)
        if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.BooleanType)):
            return None
        number = _number(name, kind)
        real = df.select(F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number).alias("v"))
        ends = real.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
        return cls(name, kind, ends["low"] or 0.0, ends["high"] or 0.0)

    @property
    def value(self) -> Column:
        return F.col(self.name) if self.length else _number(self.name, self.kind)

    @property
    def bucket(self) -> Column:
        if self.length:
            return F.substring(self.name, 1, self.length)
        width = (self.high - self.low) / _BUCKETS
        if not 0 < width < float("inf"):
            return F.when(self.value.isNotNull(), F.lit(0))
        place = F.floor((F.greatest(F.least(self.value, F.lit(self.high)), F.lit(self.low)) - F.lit(self.low)) / F.lit(width))
        # Infinite values share the outer buckets; what is not a number comes after all numbers.
        placed = F.when(F.isnan(self.value), _BUCKETS + 1).otherwise(F.least(place, F.lit(_BUCKETS)))
        return F.when(self.value.isNotNull(), placed).cast("int")

    def narrowed(self, low: object, high: object) -> _Buckets:
        if self.length:
            return _Buckets(self.name, self.kind, length=self.length + _CHARACTERS)
        return _Buckets(self.name, self.kind, low, high)


@dataclass
class _Cut:
    """Conditions for the rows that are surely among the first, and for those of which ``need`` more are."""

    taken: Column
    rest: Column
    need: int
    whole: bool = False


def _narrow(df: DataFrame, order: list[str], n: int) -> _Cut:
    """Histograms over the columns in turn, each over the bucket of the one before that holds the n-th row.

    Ends when that bucket can be ordered by one task, or holds equal rows. A histogram is aggregated before it is moved, and the
    driver reads it only up to the n-th row.
    """
    cut = _Cut(F.lit(False), F.lit(True), n)
    for name in order:
        buckets, before = _Buckets.first(df.where(cut.rest), name), None
        while buckets is not None:
            bucket = buckets.bucket
            rows = df.where(cut.rest).select(bucket.alias("bucket"), buckets.value.alias("value"))
            counts = rows.groupBy("bucket").agg(
                F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
            )
            passed, chosen = 0, None
            for row in counts.orderBy(F.asc_nulls_first("bucket")).toLocalIterator():
                if passed + row["n"] >= cut.need:
                    chosen = row
                    break
                passed += row["n"]
            if chosen is None:
                return _Cut(cut.taken | cut.rest, F.lit(False), 0, whole=True)
            earlier = F.lit(False)
            if chosen["bucket"] is not None:
                earlier = bucket.isNull() | F.coalesce(bucket < F.lit(chosen["bucket"]), F.lit(False))
            same = bucket.eqNullSafe(F.lit(chosen["bucket"]))
            cut = _Cut(cut.taken | cut.rest & earlier, cut.rest & same, cut.need - passed)
            if chosen["n"] == cut.need:
                return _Cut(cut.taken | cut.rest, F.lit(False), 0, whole=True)
            if chosen["n"] <= ORDERED_LIMIT_ROWS:
                return cut
            settled = chosen["bucket"] is None or chosen["low"] == chosen["high"]
            # A text longer than its bucket's characters goes on; numbers that no bucket can part do not.
            if settled or not buckets.length and (chosen["n"], chosen["low"]) == before:
                break
            before = (chosen["n"], chosen["low"])
            buckets = buckets.narrowed(chosen["low"], chosen["high"])
    return cut


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by the columns ``order``, ascending with nulls first, whatever the size of ``n``.

    A small ``n`` is an ordered limit. Otherwise histograms find the value of the n-th row, and a filter takes what is before it:
    nothing is sorted but the last bucket, and nothing is stored. ``df`` is read a few times, so it should be cheap to read.
    """
    if fits_one_task(df, n):
        return df.orderBy(*order).limit(n)
    cut = _narrow(df, order, n)
    if cut.whole:
        return df.where(cut.taken)
    last = df.where(cut.rest)
    if last.count() <= ORDERED_LIMIT_ROWS:
        last = last.orderBy(*order).limit(cut.need)
    else:
        # Rows that are equal in all columns with buckets; any of them, or those first by the others.
        last = number_rows(last, [F.col(c) for c in order], "_pos").filter(F.col("_pos") < cut.need).drop("_pos")
    return df.where(cut.taken).unionByName(last)


def nth_value(df: DataFrame, name: str, n: int) -> object:
    """The value of ``name`` in the row that ``n`` rows precede in its order, nulls first; None beyond the last row."""
    rows = df.select(name)
    cut = _narrow(rows, [name], n + 1)
    if cut.whole:
        inside = rows.where(cut.taken)
        return inside.agg(F.max(name)).first()[0] if inside.count() > n else None
    last = rows.where(cut.rest)
    ends = last.agg(F.min(name).alias("low"), F.max(name).alias("high")).first()
    if ends["low"] == ends["high"]:
        return ends["high"]
    return last.orderBy(name).limit(cut.need).agg(F.max(name)).first()[0]
