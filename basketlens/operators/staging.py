"""Typed, filtered staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.functions.columns import age_bucket, null_if_nan, sunday_week


def stg_transactions(raw: DataFrame, price_type: str = "double") -> DataFrame:
    """Sales with both ids and a positive price, plus calendar parts.

    ``price_type`` may be a decimal type when prices have fixed decimals: sums are then exact and do
    not depend on the order in which rows arrive.
    """
    date = F.col("t_dat").cast("date")
    price = null_if_nan(F.col("price"), raw.schema["price"].dataType.typeName())
    return raw.filter(F.col("customer_id").isNotNull() & F.col("article_id").isNotNull() & (price > 0)).select(
        date.alias("transaction_date"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("article_id").cast("string").alias("article_id"),
        price.cast(price_type).alias("price"),
        F.col("sales_channel_id").cast("int").alias("sales_channel_id"),
        F.year(date).alias("transaction_year"),
        F.month(date).alias("transaction_month"),
        sunday_week(date).alias("transaction_week"),
    )


def stg_articles(raw: DataFrame) -> DataFrame:
    typed = [F.col(c).cast("string").alias(c) for c in S.STAGED_ARTICLE_COLS]
    return raw.filter(F.col("article_id").isNotNull()).select(*typed)


def stg_customers(raw: DataFrame) -> DataFrame:
    """Ages given with decimals are rounded to the nearest year, not cut."""
    age = F.round(F.col("age").cast("double")).cast("long")
    active = F.col("active")
    if raw.select("active").schema[0].dataType.typeName() == "string":
        # Text exports write the flag as true, 1 or 1.0.
        active = F.coalesce(active.try_cast("boolean"), active.try_cast("double") != 0)
    return raw.filter(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        age.alias("age"),
        F.col("club_member_status").cast("string").alias("club_member_status"),
        F.col("fashion_news_frequency").cast("string").alias("fashion_news_frequency"),
        active.cast("boolean").alias("is_active"),
        age_bucket(age).alias("age_bucket"),
    )
