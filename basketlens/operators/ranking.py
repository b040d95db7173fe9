"""Candidate pairs and the labelled, down-sampled dataset for the ranker."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.functions.columns import sample_key
from basketlens.operators.features import feature_matrix
from basketlens.operators.membership import ArticleSets, flagged
from basketlens.plans.numbering import nth_value
from basketlens.plans.workspace import written


_KEYS = ["customer_id", "article_id"]


def _flagged(candidates: DataFrame, **tables: DataFrame | ArticleSets) -> DataFrame:
    """``candidates`` with a 0/1 column per table: whether the pair (customer_id, article_id) is in it.

    Candidates are matched as one list per customer with the customer's articles in each table, so rows that lie by customer
    already stay where they are, and only pairs move. A customer has at most a candidate list and, per table of pairs, the
    catalogue. Bitmaps are matched by bits; pairs that are used once are cheaper as rows.
    """
    if any(isinstance(t, ArticleSets) for t in tables.values()):
        return flagged(candidates, **tables)
    extra = F.struct(*[c for c in candidates.columns if c not in _KEYS])
    listed = F.sort_array(F.collect_list(F.struct("article_id", extra.alias("_row"))))
    lists = candidates.groupBy("customer_id").agg(listed.alias("_rows"))
    pairs = reduce(DataFrame.unionByName, [t.select(*_KEYS, F.lit(name).alias("_table")) for name, t in tables.items()])
    pairs = pairs.filter(F.col("customer_id").isNotNull() & F.col("article_id").isNotNull()).repartition("customer_id")
    sets = [F.collect_set(F.when(F.col("_table") == t, F.col("article_id"))).alias(t) for t in tables]
    lists = lists.join(pairs.groupBy("customer_id").agg(*sets), "customer_id", "left")
    # Of a candidate listed several times the last by its columns counts.
    following = lambda i: F.get("_rows", i + 1)["article_id"]
    last = F.filter("_rows", lambda r, i: (i == F.size("_rows") - 1) | ~following(i).eqNullSafe(r["article_id"]))
    articles = F.transform("_rows", lambda r: r["article_id"])
    owned = {t: F.array_intersect(articles, F.coalesce(F.col(t), F.array().cast("array<string>"))) for t in tables}
    lists = lists.select("customer_id", last.alias("_rows"), *[own.alias(t) for t, own in owned.items()])

    def with_flags(r: Column) -> Column:
        flags = [F.coalesce(F.array_contains(F.col(t), r["article_id"]), F.lit(False)).cast("int").alias(t) for t in tables]
        return F.struct(r["article_id"].alias("article_id"), r["_row"].alias("_row"), *flags)

    rows = lists.select("customer_id", F.inline(F.transform("_rows", with_flags)))
    return rows.select(*_KEYS, "_row.*", *tables)


def candidate_pairs(candidates: DataFrame, seen: DataFrame | ArticleSets | None = None) -> DataFrame:
    """Candidates (customer_id, article_id, als_rank from 0) with the pair features of the ranker.

    ``als_score`` is the list length minus the rank; candidates that carry their ``list_size`` need no
    window to know it. ``seen`` (pairs, or their bitmaps) flags candidates bought in training; leave it
    out when the candidates exclude them by construction, which saves matching and gives the same zeros.
    """
    if seen is None:
        return _scored(candidates, F.lit(0.0))
    return _scored(_flagged(candidates, seen=seen), F.col("seen").cast("double"))


def _scored(candidates: DataFrame, bought: Column, *kept: str) -> DataFrame:
    if "list_size" in candidates.columns:
        length = F.col("list_size")
    else:
        length = F.count(F.lit(1)).over(Window.partitionBy("customer_id"))
    return candidates.select(
        *_KEYS,
        "als_rank",
        (length - F.col("als_rank")).cast("double").alias("als_score"),
        bought.alias("ui_user_bought_item"),
        *kept,
    )


def labelled_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Label 1 where the customer bought the candidate in the label window, else 0."""
    return _flagged(pairs, label=truth)


def negative_sample(labelled: DataFrame, max_negatives: int = S.MAX_NEGATIVES, seed: int = S.SEED) -> DataFrame:
    """All positives and up to ``max_negatives`` negatives per customer who has a positive.

    Negatives are chosen by a hash of seed, customer and article. One aggregation gathers a customer's rows, never more than
    the candidate list, and drops those without a positive; the choice is made within these arrays, so no rows are sorted.
    """
    columns = [c for c in labelled.columns if c != "customer_id"]
    row = F.struct(*columns)
    keyed = F.struct(sample_key(seed, "customer_id", "article_id").alias("key"), "article_id", row.alias("row"))
    positive = F.col("label") == 1
    lists = labelled.groupBy("customer_id").agg(
        F.collect_list(F.when(positive, row)).alias("_positives"), F.collect_list(F.when(~positive, keyed)).alias("_negatives")
    )
    chosen = F.transform(F.slice(F.array_sort("_negatives"), 1, max_negatives), lambda n: n["row"])
    rows = lists.filter(F.size("_positives") > 0).select("customer_id", F.inline(F.concat("_positives", chosen)))
    return rows.select(*labelled.columns)


def ranking_dataset(
    candidates: DataFrame,
    truth: DataFrame,
    item_feats: DataFrame,
    user_feats: DataFrame,
    seen: DataFrame | ArticleSets | None = None,
    max_negatives: int = S.MAX_NEGATIVES,
    seed: int = S.SEED,
) -> DataFrame:
    """(customer_id, article_id, label, features…): a customer's rows form one ranking group.

    Ask for candidates of customers of ``truth`` only; others are dropped, but after they were moved.
    """
    tables = {"label": truth} if seen is None else {"label": truth, "seen": seen}
    bought = F.lit(0.0) if seen is None else F.col("seen").cast("double")
    pairs = _scored(_flagged(candidates, **tables), bought, "label")
    return feature_matrix(negative_sample(pairs, max_negatives, seed), item_feats, user_feats)


def ranking_dataset_stats(dataset: DataFrame) -> DataFrame:
    per_user = dataset.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    rows, pos = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("pos"), F.lit(0))
    return per_user.agg(
        rows.alias("n_rows"),
        F.count(F.lit(1)).alias("n_groups"),
        pos.alias("n_positive"),
        (rows - pos).alias("n_negative"),
    )


def ranker_group_split(dataset: DataFrame, share: float = S.TRAIN_GROUP_SHARE) -> DataFrame:
    """Whole customers to training or hold-out: the first ``share`` of them in id order train.

    The id at the cut is selected from the distinct customers, so nothing is numbered or joined.
    """
    known = dataset.filter(F.col("customer_id").isNotNull())
    users = written(known.select("customer_id").distinct(), "ranked-customers")
    edge = nth_value(users, "customer_id", math.floor(users.count() * share))
    return known.withColumn("held_out", F.lit(False) if edge is None else F.col("customer_id") >= F.lit(edge))
