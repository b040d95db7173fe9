"""Which articles a customer has to do with, as bitmaps over an article index.

A customer has one bitmap, a 64-bit number, per bucket of 64 articles that holds any of theirs: never more bitmaps than pairs,
however many articles there are. Bitmaps are built where the customer's pairs are, and merge: those of several periods are combined by OR, without the pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.plans.numbering import number_rows
from basketlens.plans.skew import lookup_join
from basketlens.plans.workspace import written

_KEYS = ["customer_id", "article_id"]
# Articles of a bucket: the bits of a number.
BUCKET = 64
# Buckets start at 0; articles without a number are in this one, which has no bitmap.
_NO_BUCKET = -1


def number_articles(articles: DataFrame) -> DataFrame:
    """(article_id, article_idx from 1) of the distinct articles, as a stored table."""
    distinct = articles.select("article_id").filter(F.col("article_id").isNotNull()).distinct()
    numbered = number_rows(distinct, [F.col("article_id")], "article_idx")
    return written(numbered.withColumn("article_idx", F.col("article_idx") + 1), "article-numbers")


def _bucket() -> Column:
    return F.floor((F.col("article_idx") - 1) / BUCKET)


def _position() -> Column:
    """The article's bit in its bucket, from 0."""
    return F.pmod(F.col("article_idx") - 1, F.lit(BUCKET)).cast("int")


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), _position())


@dataclass
class ArticleSets:
    """Bitmaps (customer_id, bucket, bitmap) over ``numbers`` (article_id, article_idx); both are stored tables."""

    numbers: DataFrame
    rows: DataFrame

    @classmethod
    def of(cls, pairs: DataFrame, numbers: DataFrame | None = None) -> ArticleSets:
        """The articles of each customer of ``pairs`` (customer_id, article_id, …); pairs lacking an id are left out.

        ``pairs`` should be a stored table if ``numbers`` are to be made of it. Articles without a number are left out.
        """
        numbers = number_articles(pairs) if numbers is None else numbers
        placed = _placed(pairs, numbers).repartition("customer_id")
        bitmaps = placed.groupBy("customer_id", _bucket().alias("bucket")).agg(F.bit_or(_bit()).alias("bitmap"))
        return cls(numbers, written(bitmaps, "article-sets"))

    def merged(self, other: ArticleSets) -> ArticleSets:
        """The articles in either; both must have the same numbers."""
        rows = self.rows.unionByName(other.rows).groupBy("customer_id", "bucket")
        return ArticleSets(self.numbers, written(rows.agg(F.bit_or("bitmap").alias("bitmap")), "article-sets"))

    def sizes(self) -> DataFrame:
        """(customer_id, n_articles)."""
        return self.rows.groupBy("customer_id").agg(F.sum(F.bit_count("bitmap")).alias("n_articles"))

    def save(self, path: str) -> None:
        self.numbers.write.mode("overwrite").parquet(f"{path}/numbers")
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ArticleSets:
        return cls(spark.read.parquet(f"{path}/numbers"), spark.read.parquet(f"{path}/rows"))


def _placed(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """(customer_id, article_idx) of the pairs whose ids are both known."""
    whole = pairs.filter(F.col("customer_id").isNotNull() & F.col("article_id").isNotNull()).select(*_KEYS)
    return lookup_join(whole, numbers, "article_id", "inner").select("customer_id", "article_idx")


def flagged(candidates: DataFrame, **tables: DataFrame | ArticleSets) -> DataFrame:
    """``candidates`` (customer_id, article_id, …) with a 0/1 column per table: whether the pair is in it.

    All rows go to their customer's task in one exchange and are matched there; whatever is grouped or ordered by
    customer afterwards stays in that task. Tables are stored bitmaps, at most one row per customer and bucket, or pairs, which
    move as customer and number and become bitmaps in the customer's task. All stored bitmaps must have the same numbers.
    Repeated candidates stay repeated; rows lacking an id are in no table.
    """
    stored = [t for t in tables.values() if isinstance(t, ArticleSets)]
    numbers = _numbers_of([t for t in tables.values() if not isinstance(t, ArticleSets)], stored[0].numbers if stored else None)
    extra = [c for c in candidates.columns if c not in _KEYS]
    bucket = F.coalesce(_bucket(), F.lit(_NO_BUCKET).cast("long")).alias("bucket")
    rows = lookup_join(candidates, numbers, "article_id").select(
        "customer_id", bucket, F.struct(F.struct("article_id", *extra).alias("_row"), _position().alias("at")).alias("_asked")
    )
    aggregates = [F.collect_list("_asked").alias("_rows")]
    for name, table in tables.items():
        if isinstance(table, ArticleSets):
            more = table.rows.select("customer_id", "bucket", F.col("bitmap").alias(name))
        else:
            more = _placed(table, numbers).select("customer_id", _bucket().alias("bucket"), _bit().alias(name))
        aggregates.append(F.bit_or(name).alias(name))
        rows = rows.unionByName(more, allowMissingColumns=True)
    matched = rows.repartition("customer_id").groupBy("customer_id", "bucket").agg(*aggregates)

    def with_flags(listed: Column) -> Column:
        row, at = listed["_row"], listed["at"]
        known = F.col("customer_id").isNotNull() & at.isNotNull()
        flags = [F.when(known, F.coalesce(F.getbit(F.col(t), at).cast("int"), F.lit(0))).otherwise(F.lit(0)).alias(t) for t in tables]
        return F.struct(row["article_id"].alias("article_id"), *[row[c].alias(c) for c in extra], *flags)

    listed = matched.filter(F.size("_rows") > 0)
    return listed.select("customer_id", F.inline(F.transform("_rows", with_flags)))


def _numbers_of(tables: list[DataFrame], known: DataFrame | None) -> DataFrame:
    """``known`` numbers, and further ones for the articles of ``tables`` of pairs that have none."""
    if not tables:
        return known
    articles = tables[0].select("article_id")
    for table in tables[1:]:
        articles = articles.unionByName(table.select("article_id"))
    if known is None:
        return number_articles(articles)
    more = number_articles(articles.join(known, "article_id", "left_anti"))
    last = known.agg(F.coalesce(F.max("article_idx"), F.lit(0))).first()[0]
    return known.unionByName(more.withColumn("article_idx", F.col("article_idx") + last))
