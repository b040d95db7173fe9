"""Interaction, user and item marts.

All three start from one aggregation per (customer, article, day): the heaviest shuffle happens once,
on a key that no hot customer or article can dominate, and the marts aggregate its smaller result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.plans.workspace import written


def daily_purchases(stg_tx: DataFrame) -> DataFrame:
    """Purchases and spend per customer, article and day."""
    return stg_tx.groupBy("customer_id", "article_id", "transaction_date").agg(
        F.count(F.lit(1)).alias("purchase_count"), F.sum("price").alias("spend")
    )


def marked_purchases(stg_tx: DataFrame) -> DataFrame:
    """:func:`daily_purchases` with ``first_of_pair``, true on one row per customer and article: counting these rows counts
    the articles of a customer and the customers of an article, with no shuffle of the pairs.

    Sales are aggregated before they are ranged over (customer, article), so that a pair with many sales is one row a day by
    then. A range holds all days of a pair, and the rows of a customer next to each other: what is aggregated per customer
    shrinks before it moves. A hot customer is still spread over several ranges.
    """
    days = Window.partitionBy("customer_id", "article_id").orderBy("transaction_date")
    daily = daily_purchases(stg_tx).repartitionByRange("customer_id", "article_id")
    return daily.withColumn("first_of_pair", F.row_number().over(days) == 1)


def fct_user_item_interactions(stg_tx: DataFrame) -> DataFrame:
    """Purchases and spend per customer, article and day, with a logarithmic confidence."""
    return interactions_from(daily_purchases(stg_tx))


def interactions_from(daily: DataFrame) -> DataFrame:
    return daily.select(
        "customer_id",
        "article_id",
        "transaction_date",
        "purchase_count",
        F.col("spend").cast("double").alias("total_spend"),
        (1 + F.ln("purchase_count")).alias("implicit_confidence"),
    )


def fct_user_features(stg_tx: DataFrame, stg_cust: DataFrame, as_of: Column) -> DataFrame:
    """One row per buying customer: profile, purchase totals, distinct active days, days since last."""
    return user_mart_from(written(marked_purchases(stg_tx), "daily"), stg_cust, as_of)


def user_mart_from(daily: DataFrame, stg_cust: DataFrame, as_of: Column) -> DataFrame:
    """``daily`` are :func:`marked_purchases`, and should be a stored table: it is read for the totals and for the days."""
    spend, count = F.sum("spend").cast("double"), F.sum("purchase_count")
    totals = daily.groupBy("customer_id").agg(
        F.count_if("first_of_pair").alias("total_unique_items"),
        count.alias("total_purchases"),
        spend.alias("total_spend"),
        (spend / count).alias("avg_item_price"),
        F.max("transaction_date").alias("last_purchase_date"),
        F.min("transaction_date").alias("first_purchase_date"),
    )
    days = daily.select("customer_id", "transaction_date").distinct()
    active = days.groupBy("customer_id").agg(F.count("transaction_date").alias("active_days"))
    stats = totals.join(active, "customer_id")
    return stats.join(stg_cust, "customer_id", "left").select(
        "customer_id",
        "age",
        "age_bucket",
        "club_member_status",
        "fashion_news_frequency",
        "is_active",
        "total_unique_items",
        "total_purchases",
        "total_spend",
        "avg_item_price",
        "active_days",
        "last_purchase_date",
        "first_purchase_date",
        F.datediff(as_of, "last_purchase_date").alias("days_since_last_purchase"),
    )


def fct_item_features(stg_tx: DataFrame, stg_art: DataFrame, as_of: Column) -> DataFrame:
    """One row per catalogue article, sold or not, with popularity relative to the widest-sold one."""
    return item_mart_from(marked_purchases(stg_tx), stg_art, as_of)


def item_mart_from(daily: DataFrame, stg_art: DataFrame, as_of: Column) -> DataFrame:
    """``daily`` are :func:`marked_purchases`."""
    spend, count = F.sum("spend").cast("double"), F.sum("purchase_count")
    # One row per sold article, written so that the maximum does not aggregate the sales again.
    stats = written(
        daily.groupBy("article_id").agg(
            F.count_if("first_of_pair").alias("buyers"),
            count.alias("purchases"),
            (spend / count).alias("mean_price"),
            F.max("transaction_date").alias("last_sold_date"),
        ),
        "item-stats",
    )
    sold = stg_art.join(stats, "article_id", "left").withColumn(
        "unique_buyers", F.coalesce("buyers", F.lit(0))
    )
    # Over the catalogue, not over all sales: an article missing from it does not set the scale.
    widest = sold.agg(F.max("unique_buyers")).scalar()
    return sold.select(
        "article_id",
        "product_type_name",
        "product_group_name",
        "colour_group_name",
        "department_name",
        "index_group_name",
        "section_name",
        "garment_group_name",
        "unique_buyers",
        F.coalesce("purchases", F.lit(0)).alias("total_purchases"),
        F.coalesce("mean_price", F.lit(0.0)).alias("avg_price"),
        "last_sold_date",
        F.datediff(as_of, "last_sold_date").alias("days_since_last_sold"),
        F.try_divide(F.col("unique_buyers"), widest).alias("popularity_score"),
    )
