"""Raw table scans: transactions, articles, customers; the latest-rows selection; the raw table sink."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.functions.columns import article_key, customer_key, null_if_nan
from basketlens.plans.numbering import first_rows


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan one raw table. CSV columns come by header name, as strings, with no inference pass."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(
            f"Required data not found: {path}. Put the raw transactions, articles and customers tables "
            "there, or pass the path they are at."
        ) from exc


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions with normalised ids. A date that cannot be read fails the job."""
    price = F.col("price").cast("double") if _is_text(raw, "price") else F.col("price")
    kind = "double" if _is_text(raw, "price") else raw.schema["price"].dataType.typeName()
    return raw.select(
        F.to_date("t_dat").alias("t_dat"),
        customer_key(F.col("customer_id")).alias("customer_id"),
        article_key(F.col("article_id")).alias("article_id"),
        null_if_nan(price, kind).alias("price"),
        F.col("sales_channel_id").cast("int").alias("sales_channel_id"),
    )


def split_unreadable(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose date, price and channel can be read, and the others with the reason."""
    reason = (
        F.when(F.col("t_dat").isNotNull() & F.col("t_dat").try_cast("date").isNull(), "t_dat")
        .when(F.col("price").isNotNull() & F.col("price").try_cast("double").isNull(), "price")
        .when(
            F.col("sales_channel_id").isNotNull() & F.col("sales_channel_id").try_cast("int").isNull(),
            "sales_channel_id",
        )
    )
    marked = raw.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def latest_transactions(tx: DataFrame, n_rows: int = S.LATEST_ROWS) -> DataFrame:
    """The ``n_rows`` latest rows by date.

    Rows per day (as many as there are days) tell which days are in completely; only the day on the
    edge has to be ordered, by all its columns, to take the missing rows from it.
    """
    if n_rows < 1:
        raise ValueError("n_rows must be at least 1")
    per_day = tx.filter(F.col("t_dat").isNotNull()).groupBy("t_dat").count()
    missing, edge = n_rows, None
    for day, n in per_day.orderBy(F.desc("t_dat")).toLocalIterator():
        edge = day
        if n >= missing:
            break
        missing -= n
    if edge is None:
        return tx.limit(0)
    whole_days = tx.filter(F.col("t_dat") > F.lit(edge))
    others = [c for c in tx.columns if c != "t_dat"]
    return whole_days.unionByName(first_rows(tx.filter(F.col("t_dat") == F.lit(edge)), others, missing))


def load_transactions(
    spark: SparkSession, path: str, fmt: str = "csv", n_rows: int | None = None
) -> DataFrame:
    """All rows, or the ``n_rows`` latest."""
    tx = clean_transactions(read_table(spark, path, fmt))
    return tx if n_rows is None else latest_transactions(tx, n_rows)


def clean_articles(raw: DataFrame) -> DataFrame:
    return raw.select(*S.LOADED_ARTICLE_COLS).withColumn("article_id", article_key(F.col("article_id")))


def load_articles(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return clean_articles(read_table(spark, path, fmt))


def clean_customers(raw: DataFrame) -> DataFrame:
    return raw.select(*S.LOADED_CUSTOMER_COLS).withColumn("customer_id", customer_key(F.col("customer_id")))


def load_customers(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return clean_customers(read_table(spark, path, fmt))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Replace the table at ``path`` and check the row count: rows given against rows found there.

    The rows given are counted while they are written, so the input is computed once.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    rows_in = seen.get["rows"]
    rows_out = df.sparkSession.read.schema(df.schema).format(fmt).load(path).count()
    if rows_in != rows_out:
        raise RuntimeError(f"{path}: {rows_in} rows given but {rows_out} found after the load")
    return {"rows_in": rows_in, "rows_out": rows_out}


def _is_text(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "string"
