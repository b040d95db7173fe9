"""Ranking metrics as one join and one aggregation.

Inputs are long tables: recommendations (customer_id, article_id, rank from 1) and truth (customer_id,
article_id), both unique per pair. A customer's metrics need only the number of true articles and the ranks
of the hits, of which there are at most ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hits_at_k(recs: DataFrame, truth: DataFrame, k: int, by: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """Per customer of the truth: number of true articles and the sorted ranks of those recommended.

    A customer without recommendations keeps an empty list. ``by`` may name further columns shared by both
    tables (a model or split name).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    top = recs.filter(F.col("rank") <= k).select(*by, "article_id", "rank")
    return (
        truth.select(*by, "article_id")
        .join(top, [*by, "article_id"], "left")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rel"),
            F.array_sort(F.collect_list("rank")).alias("hit_ranks"),
        )
    )


def _sum_over(array: Column, term) -> Column:  # noqa: ANN001
    return F.aggregate(F.transform(array, term), F.lit(0.0), lambda a, b: a + b)


def dcg(hit_ranks: Column) -> Column:
    return _sum_over(hit_ranks, lambda r: 1 / F.log2(r + 1))


def ideal_dcg(n_rel: Column, k: int) -> Column:
    best = F.sequence(F.lit(1), F.least(n_rel, F.lit(k)).cast("int"))
    return _sum_over(best, lambda r: 1 / F.log2(r + 1))


def average_precision(hit_ranks: Column, n_rel: Column, k: int) -> Column:
    """The j-th hit at rank r contributes j / r; divided by the hits that were possible."""
    precision = F.transform(hit_ranks, lambda r, j: (j + 1) / r)
    return F.aggregate(precision, F.lit(0.0), lambda a, b: a + b) / F.least(n_rel, F.lit(k))


def per_user_metrics(recs: DataFrame, truth: DataFrame, k: int, by: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    hits, n_rel = F.col("hit_ranks"), F.col("n_rel")
    return hits_at_k(recs, truth, k, by).select(
        *by,
        "n_rel",
        dcg(hits).alias("dcg"),
        (dcg(hits) / ideal_dcg(n_rel, k)).alias("ndcg"),
        (F.size(hits) / n_rel).alias("recall"),
        average_precision(hits, n_rel, k).alias("map"),
        F.when(F.size(hits) > 0, 1.0).otherwise(0.0).alias("hit_rate"),
    )


def mean_metrics(per_user: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Averages over customers and their number; no customers at all gives zeros."""
    names = ["ndcg", "recall", "map", "hit_rate"]
    return per_user.groupBy(*by).agg(
        *[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in names], F.count(F.lit(1)).alias("n_users")
    )
