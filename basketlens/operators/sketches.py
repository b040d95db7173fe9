"""Statistics of any date range from one small row of sketches per day.

A day's row has exact sums and bounds, HyperLogLog sketches of customers and articles, and a quantile sketch of prices. Rows
merge: new days are added, late rows of old days are merged in, and a range is the merge of its days, so that no
statistic needs a second scan of the transactions. A row is a few kilobytes, however many transactions a day has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import null_if_nan

# The relative standard error of a merged count is 1.04 / sqrt(2 ** LG_K) = 1.6 %.
LG_K = 12
# The rank error of a quantile is at most RANK_ERROR with 99 % confidence at this size.
QUANTILE_K = 200
RANK_ERROR = 0.0165
COUNT_ERROR = 1.04 / 2 ** (LG_K / 2)

_SUMS = ["row_count", "null_customer_id", "null_article_id", "null_price"]
_COUNTED = {"customers": "customer_id", "articles": "article_id"}


def daily_sketches(tx: DataFrame) -> DataFrame:
    """One row per day of ``tx``; rows without a date make a row of their own, with a null day.

    Prices that are null or not a number count as missing and are in no quantile. Partial sketches are made where the
    rows are, so a day that holds a third of the table is a few kilobytes per task in the shuffle.
    """
    price = null_if_nan(F.col("price"), tx.schema["price"].dataType.typeName())
    rows = tx.select(F.col("t_dat").cast("date").alias("day"), "customer_id", "article_id", price.alias("price"))
    return rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("customer_id", "article_id", "price")],
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(name) for name, c in _COUNTED.items()],
        F.kll_sketch_agg_double(F.col("price").cast("double"), F.lit(QUANTILE_K)).alias("prices"),
    )


def merge_sketches(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """The rows of ``sketches`` merged per group of ``by``; without, all of them in one row."""
    return sketches.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
        *[F.hll_union_agg(c).alias(c) for c in _COUNTED],
        F.kll_merge_agg_double("prices").alias("prices"),
        F.min("day").alias("date_min"),
        F.max("day").alias("date_max"),
    )


def add_days(sketches: DataFrame, tx: DataFrame) -> DataFrame:
    """``sketches`` with the rows of ``tx``, on days that are there already and on new ones."""
    return merge_sketches(sketches.unionByName(daily_sketches(tx)), "day").drop("date_min", "date_max")


def statistics(merged: DataFrame, quantiles: list[float]) -> DataFrame:
    """The merged rows with numbers in the place of sketches; ``price_quantiles`` is null without any price."""
    for q in quantiles:
        if not 0 <= q <= 1:
            raise ValueError(f"{q} is not a share")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    some = F.col("row_count") > F.col("null_price")
    return merged.withColumns(
        {
            **{f"unique_{c}": F.hll_sketch_estimate(c) for c in _COUNTED},
            "price_quantiles": F.when(some, F.kll_sketch_get_quantile_double("prices", wanted)),
        }
    ).drop(*_COUNTED, "prices")


def range_statistics(
    sketches: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    quantiles: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95),
) -> DataFrame:
    """One row of statistics of the days from ``start`` to ``end``, both included.

    Without bounds all rows count, also those without a date. A range without rows has counts of 0 and null elsewhere.
    """
    day, days = F.col("day"), sketches
    if start is not None:
        days = days.filter(day >= F.lit(start).cast("date"))
    if end is not None:
        days = days.filter(day <= F.lit(end).cast("date"))
    return statistics(merge_sketches(days), list(quantiles)).fillna(0, [*_SUMS, *[f"unique_{c}" for c in _COUNTED]])
