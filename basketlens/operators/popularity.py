"""Popularity ranking and per-customer popular articles that the customer has not bought yet."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.operators.features import seen_items_from, user_seen_items
from basketlens.plans.numbering import first_rows, fits_one_task, number_rows
from basketlens.plans.skew import fits_broadcast
from basketlens.plans.workspace import written

# Length of the ranked prefix that is broadcast to answer ordinary customers.
PREFIX_ROWS = 10_000
# Listed rows per task. Whoever gathers a customer's rows again sorts them within the task, in memory if they are so few.
ROWS_PER_TASK = 1_000_000
# Ranks handed to one task at a time for customers who bought most of that prefix.
CHUNK = 4096


def popularity_counts(train: DataFrame) -> DataFrame:
    """Purchases per article."""
    return (
        train.filter(F.col("article_id").isNotNull())
        .groupBy("article_id")
        .agg(F.count(F.lit(1)).alias("purchase_count"))
    )


def _order() -> list:
    return [F.desc("purchase_count"), F.asc("article_id")]


def top_k(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most bought articles with their rank from 1; equal counts go by article id.

    The window sees at most ``k`` rows, and only while these are few; longer rankings are numbered in parallel.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if not fits_one_task(counts, k):
        falling = counts.withColumn("_fewer", -F.col("purchase_count"))
        first = first_rows(falling, ["_fewer", "article_id"], k).drop("_fewer")
        numbered = number_rows(first, _order(), "_pos")
        return numbered.withColumn("pop_rank", (F.col("_pos") + 1).cast("int")).drop("_pos")
    rank = F.row_number().over(Window.orderBy(*_order()))
    return counts.orderBy(*_order()).limit(k).withColumn("pop_rank", rank)


def _tasks(users: DataFrame, k: int) -> int | None:
    """Tasks for lists of ``k`` rows per customer; None while as many tasks as cores are enough.

    Never fewer than the session's shuffle partitions, so that tables joined to the lists move and the lists do not.
    """
    spark, rows = users.sparkSession, users.count() * k
    if rows <= ROWS_PER_TASK * spark.sparkContext.defaultParallelism:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


@dataclass
class PopularityModel:
    """Fitted baseline: purchase counts per article and the pairs seen in training.

    Both are stored tables: their sizes and the ranking's prefix are cheap to ask for repeatedly.
    """

    counts: DataFrame
    seen: DataFrame
    prefix_rows: int = PREFIX_ROWS

    @classmethod
    def fit(cls, train: DataFrame, stats: DataFrame | None = None, **options: int) -> PopularityModel:
        """Count the training purchases, from ``interaction_stats`` of the same rows if they are given."""
        if "article_id" not in train.columns:
            raise ValueError("popularity counts the column article_id")
        if stats is None:
            counts = popularity_counts(train)
        else:
            bought = stats.filter(F.col("article_id").isNotNull()).groupBy("article_id")
            counts = bought.agg(F.sum("purchase_count").alias("purchase_count"))
        counts = written(counts, "popularity")
        if counts.isEmpty():
            raise ValueError("no purchase to count: the table is empty")
        if stats is not None:
            seen = seen_items_from(stats)
        elif "customer_id" in train.columns:
            seen = written(user_seen_items(train), "seen")
        else:
            seen = counts.select(F.lit(None).cast("string").alias("customer_id"), "article_id").limit(0)
        return cls(counts, seen, **options)

    @property
    def n_articles(self) -> int:
        return self.counts.count()

    @cached_property
    def longest_history(self) -> int:
        """The largest number of distinct articles any customer bought."""
        per_user = self.seen.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        return per_user.agg(F.max("n")).first()[0] or 0

    def top_k(self, k: int = 10) -> DataFrame:
        return top_k(self.counts, k)

    def recommend(self, users: DataFrame, k: int = 10, exclude_seen: bool = True) -> DataFrame:
        """Up to ``k`` articles per customer in ``users``: (customer_id, article_id, rank).

        A customer unknown to training gets the global list. Ordinary customers are answered from a
        broadcast prefix of the ranking: whoever bought ``c`` of its articles finds ``k`` unseen ones
        among its first ``k + c``. Customers whose history could reach past the prefix take the second
        way, over the whole ranking; they are few, as each holds nearly a prefix length of pairs.
        """
        if k < 1:
            raise ValueError("k must be at least 1")
        users = written(users.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct(), "asked-customers")
        size = max(self.prefix_rows, 2 * k)
        if not exclude_seen:
            prefix = self._prefix(k)
            ranks = users.withColumn("pop_rank", F.explode(F.sequence(F.lit(1), F.lit(k))))
            return ranks.join(prefix, "pop_rank").select(
                "customer_id", "article_id", F.col("pop_rank").alias("rank")
            )
        if self.n_articles <= size or self.longest_history + k <= size:
            return self._recommend_prefix(users, k, size)
        long = self.seen.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") + k > size)
        heavy = written(users.join(long.select("customer_id"), "customer_id", "left_semi"), "heavy-buyers")
        light = users.join(heavy, "customer_id", "left_anti")
        return self._recommend_prefix(light, k, size).unionByName(self._recommend_deep(heavy, k))

    def _prefix(self, n: int) -> DataFrame:
        """The first ``n`` ranks, to be broadcast if they are few enough."""
        prefix = written(top_k(self.counts, n).select("article_id", "pop_rank"), "popular-prefix")
        return F.broadcast(prefix) if fits_broadcast(prefix) else prefix

    def _recommend_prefix(self, users: DataFrame, k: int, size: int) -> DataFrame:
        """Lists from the first ``size`` ranks; at most that many ranks are collected per customer."""
        prefix = self._prefix(size)
        pairs, tasks = self.seen.join(prefix, "article_id"), _tasks(users, k)
        if tasks is not None:
            # A list is far longer than what was moved for it, so tasks are not to be merged by that.
            users, pairs = users.repartition(tasks, "customer_id"), pairs.repartition(tasks, "customer_id")
        bought = pairs.groupBy("customer_id").agg(F.collect_list("pop_rank").alias("bought"))
        none = F.array().cast("array<int>")
        depth = users.join(bought, "customer_id", "left").withColumn("bought", F.coalesce("bought", none))
        reach = F.least(k + F.size("bought"), F.lit(size))
        unseen = F.slice(F.array_except(F.sequence(F.lit(1), reach), "bought"), 1, k)
        return (
            depth.select("customer_id", F.posexplode(unseen).alias("pos", "pop_rank"))
            .join(prefix, "pop_rank")
            .select("customer_id", "article_id", (F.col("pos") + 1).alias("rank"))
        )

    def _recommend_deep(self, users: DataFrame, k: int) -> DataFrame:
        """The exact list for customers who bought nearly the whole prefix.

        Each customer is expanded into the ranks 1 … k + bought, in chunks that spread over tasks; bought
        articles are removed on (customer, article), where no customer is a hot key; the window limit keeps
        ``k`` rows per customer and task before the last shuffle.
        """
        ranking = number_rows(self.counts.select("article_id", "purchase_count"), _order(), "pos").select(
            "article_id", (F.col("pos") + 1).alias("pop_rank")
        )
        bought = self.seen.join(users, "customer_id", "left_semi")
        need = bought.groupBy("customer_id").agg((F.count(F.lit(1)) + k).alias("need"))
        chunks = need.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("need") - 1) / CHUNK))))
        first = F.col("chunk") * CHUNK + 1
        last = F.least(first + CHUNK - 1, F.col("need"))
        ranks = chunks.repartition("customer_id", "chunk").select(
            "customer_id", F.explode(F.sequence(first, last)).alias("pop_rank")
        )
        candidates = ranks.join(ranking, "pop_rank").join(bought, ["customer_id", "article_id"], "left_anti")
        order = Window.partitionBy("customer_id").orderBy("pop_rank")
        return (
            candidates.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select("customer_id", "article_id", "rank")
        )

    def save(self, path: str) -> None:
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        self.seen.write.mode("overwrite").parquet(f"{path}/seen")

    @classmethod
    def load(cls, spark: SparkSession, path: str, **options: int) -> PopularityModel:
        return cls(spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/seen"), **options)
