"""The shared test tables seen as retail tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.plans.workspace import written

# Cutoffs at 75 % and 87.5 % of the test tables' day range.
VAL_START = "1999-12-09"
TEST_START = "2000-10-05"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(col: str) -> Column:
    return F.lpad(F.col(col).cast("string"), 10, "0")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    day = F.col("o_orderdate").cast("date").alias("t_dat")
    # Ids are written out after the rows have moved.
    return lines.join(orders, "l_orderkey").select(day, *lines.columns, "o_custkey").repartitionByRange("t_dat", "o_custkey").select(
        "t_dat",
        _key("o_custkey").alias("customer_id"),
        _key("l_partkey").alias("article_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        (1 + F.col("l_orderkey") % 2).cast("int").alias("sales_channel_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "o_custkey",
    )


_ingested: dict[tuple[str, str], DataFrame] = {}


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that still carry their order keys. Prices have two decimals, kept exact.

    Lines and orders are joined once per session and stored as the raw transactions table that all
    queries scan. Files cover ranges of (day, customer): date windows skip files, and one busy day is
    still spread over several.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ingested:
        _ingested[key] = written(_order_lines(spark, sf_dir), "raw-transactions")
    return _ingested[key]


_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).drop(*_KEYS)


def cold_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlay A: some customers and articles have no history before the validation window."""
    early = F.col("t_dat") < F.lit(VAL_START).cast("date")
    dropped = early & ((F.col("o_custkey") % 6 == 0) | (F.col("l_partkey") % 9 == 0))
    return order_lines(spark, sf_dir).filter(~dropped).drop(*_KEYS)


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlay B: rows damaged by rule, for the validators; some article ids are no numbers."""
    key = F.col("l_orderkey")
    price = (
        F.when(key % 503 == 0, None)
        .when(key % 499 == 0, F.lit(0))
        .when(key % 509 == 0, -F.col("price"))
        .otherwise(F.col("price"))
    )
    return order_lines(spark, sf_dir).select(
        F.when(key % 1021 != 0, F.col("t_dat")).alias("t_dat"),
        F.when(key % 1009 != 0, F.col("customer_id")).alias("customer_id"),
        F.when((key + F.col("l_linenumber")) % 1013 == 0, None)
        .when(key % 479 == 0, F.concat(F.lit("x"), "article_id"))
        .otherwise(F.col("article_id"))
        .alias("article_id"),
        price.cast("decimal(18,2)").alias("price"),
        F.when(key % 487 == 0, 9).otherwise(F.col("sales_channel_id")).alias("sales_channel_id"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        _key("p_partkey").alias("article_id"),
        F.col("p_type").alias("product_type_name"),
        F.col("p_brand").alias("product_group_name"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("graphical_appearance_name"),
        words[0].alias("colour_group_name"),
        words[1].alias("department_name"),
        F.col("p_type").alias("index_group_name"),
        F.col("p_type").alias("section_name"),
        F.col("p_type").alias("garment_group_name"),
        F.concat("p_brand", F.lit(" "), "p_name").alias("detail_desc"),
    )


def dirty_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with repeated ids, missing ids and missing attributes."""
    art = articles(spark, sf_dir)
    number = F.col("article_id").cast("long")
    damaged = art.withColumns(
        {
            "article_id": F.when(number % 101 != 0, F.col("article_id")),
            "department_name": F.when(number % 7 != 0, F.col("department_name")),
        }
    )
    return damaged.unionByName(art.filter(number % 97 == 0))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _key("c_custkey").alias("customer_id"),
        F.when(key % 23 != 0, 18 + key % 60).alias("age"),
        F.col("c_mktsegment").alias("club_member_status"),
        F.when(key % 3 == 0, "NONE").when(key % 3 == 1, "Regularly").otherwise("Monthly").alias(
            "fashion_news_frequency"
        ),
        (F.col("c_acctbal") > 0).alias("active"),
    )


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = customers(spark, sf_dir)
    number = F.col("customer_id").cast("long")
    damaged = cust.withColumn("customer_id", F.when(number % 89 != 0, F.col("customer_id")))
    return damaged.unionByName(cust.filter(number % 97 == 0))
