"""Train-only item and user features, and the feature matrix of candidate pairs.

Both feature tables, the seen items, the popularity counts and the ALS counts all derive from one row per
(customer, article): ``interaction_stats``. It is the only aggregation over raw transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.functions.columns import feature_value, null_if_nan
from basketlens.plans.skew import lookup_join
from basketlens.plans.workspace import written


def interaction_stats(train: DataFrame) -> DataFrame:
    """One row per (customer, article), missing ids included as groups of their own."""
    price = null_if_nan(F.col("price"), train.schema["price"].dataType.typeName())
    online = (
        F.count_if(F.coalesce(F.col("sales_channel_id") == 1, F.lit(False)))
        if "sales_channel_id" in train.columns
        else F.lit(0).cast("long")
    )
    day = F.col("t_dat").cast("date")
    return train.groupBy("customer_id", "article_id").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.sum(price).alias("spend"),
        F.count(price).alias("priced"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        online.alias("online"),
    )


def item_features_from(stats: DataFrame) -> DataFrame:
    """Reach, volume, mean price, recency against the last training day, share of the widest reach.

    The per-article totals are written (one row per article) so that the widest reach and the last day
    are read from them and ``stats`` is aggregated once. Rows without an article still count for the day.
    """
    items = written(
        stats.groupBy("article_id").agg(
            F.count("customer_id").alias("buyers"),
            F.sum("purchase_count").alias("purchases"),
            F.try_divide(F.sum("spend").cast("double"), F.sum("priced")).alias("mean_price"),
            F.max("last_day").alias("last_day"),
        ),
        "item-totals",
    )
    named = items.filter(F.col("article_id").isNotNull())
    widest = named.agg(F.max("buyers")).scalar()
    last_day = items.agg(F.max("last_day")).scalar()
    return named.select(
        "article_id",
        F.col("buyers").cast("float").alias("item_unique_buyers"),
        F.col("purchases").cast("float").alias("item_purchase_count"),
        F.col("mean_price").cast("float").alias("item_avg_price"),
        F.coalesce(F.try_divide(F.col("buyers"), widest), F.lit(0.0)).cast("float").alias("item_popularity_score"),
        F.datediff(last_day, "last_day").cast("float").alias("item_recency_days"),
    )


def user_features_from(stats: DataFrame) -> DataFrame:
    """Volume, breadth, spend, span between first and last day, recency, share of online rows.

    ``stats`` should be a stored table: the last day is one more scan of one of its columns.
    """
    users = (
        stats.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.sum("purchase_count").alias("purchases"),
            F.count("article_id").alias("articles"),
            F.coalesce(F.sum("spend").cast("double"), F.lit(0.0)).alias("spend"),
            F.sum("priced").alias("priced"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            F.sum("online").alias("online"),
        )
    )
    last_day = stats.agg(F.max("last_day")).scalar()
    return users.select(
        "customer_id",
        F.col("purchases").cast("float").alias("user_purchase_count"),
        F.col("articles").cast("float").alias("user_unique_items"),
        F.col("spend").cast("float").alias("user_total_spend"),
        F.try_divide("spend", "priced").cast("float").alias("user_avg_spend"),
        F.datediff("last_day", "first_day").cast("float").alias("user_active_days"),
        F.datediff(last_day, "last_day").cast("float").alias("user_recency_days"),
        (F.col("online") / F.col("purchases")).cast("float").alias("user_online_ratio"),
    )


def item_features(train: DataFrame) -> DataFrame:
    return item_features_from(interaction_stats(train))


def user_features(train: DataFrame) -> DataFrame:
    return user_features_from(written(interaction_stats(train), "stats"))


def seen_items_from(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("customer_id").isNotNull() & F.col("article_id").isNotNull()).select(
        "customer_id", "article_id"
    )


def user_seen_items(train: DataFrame) -> DataFrame:
    """Distinct (customer, article) pairs; a long table, never a per-customer collection."""
    return seen_items_from(train.select("customer_id", "article_id").distinct())


def feature_matrix(pairs: DataFrame, item_feats: DataFrame, user_feats: DataFrame) -> DataFrame:
    """The pairs with all features in training order as 32-bit floats, unknown ids as 0.

    Keys and any other pair columns (label, …) are kept in front. Popular articles repeat in nearly every
    customer's list, hence the lookup join; a customer repeats at most once per candidate, and joins first, while the pairs
    still lie by customer.
    """
    joined = lookup_join(pairs.join(user_feats, "customer_id", "left"), item_feats, "article_id")
    kept = [c for c in pairs.columns if c not in S.FEATURE_COLS]
    return joined.select(*kept, *[feature_value(F.col(c)).alias(c) for c in S.FEATURE_COLS])
