"""Data quality checks of the three raw tables.

A check is hard (``error``: the data must not be used) or soft (``warning``). The transaction checks read
the table once: one aggregation per (customer, article, day) carries the row-level flags as sums, and every
check is computed from its output. Findings come as a long table, one row per failed check.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import schemas as S
from basketlens.functions.columns import null_if_nan
from basketlens.plans.workspace import written

log = logging.getLogger(__name__)

FINDING_COLS = ["table_name", "severity", "check_name", "n_rows"]


class DataValidationError(ValueError):
    """A hard check failed."""


@dataclass
class ValidationReport:
    """The findings and statistics of one table, small enough for the driver."""

    table: str
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    stats: dict = field(default_factory=dict)

    @property
    def has_errors(self) -> bool:
        return bool(self.errors)

    def summary(self) -> str:
        outcome = "FAILED" if self.has_errors else "PASSED"
        body = [f"{k} = {v}" for k, v in self.stats.items()]
        body += [f"warning: {w}" for w in self.warnings]
        body += [f"error: {e}" for e in self.errors]
        head = f"{self.table}: {outcome}, {len(self.errors)} errors, {len(self.warnings)} warnings"
        return "\n  ".join([head, *body])

    def raise_on_errors(self) -> None:
        if self.has_errors:
            raise DataValidationError(self.summary())

    def log(self) -> None:
        level = logging.ERROR if self.has_errors else logging.WARNING if self.warnings else logging.INFO
        log.log(level, "%s", self.summary())


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")


def _flagged(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _bad_channel() -> Column:
    return ~F.coalesce(F.col("sales_channel_id").isin(S.VALID_CHANNELS), F.lit(False))


def transaction_profile(
    tx: DataFrame, min_date: str = S.MIN_DATE, max_date: str = S.MAX_DATE, approximate: bool = False
) -> DataFrame:
    """One row with every count the transaction checks and statistics need.

    With ``approximate`` the distinct customers and articles are estimated in the same pass. Otherwise they are counted
    over the aggregated keys, which are stored for that.
    """
    price = null_if_nan(F.col("price"), tx.schema["price"].dataType.typeName())
    keyed = tx.groupBy("customer_id", "article_id", "t_dat").agg(
        F.count(F.lit(1)).alias("n"),
        _flagged(price.isNull()).alias("null_price"),
        _flagged(price <= 0).alias("bad_price"),
        _flagged(_bad_channel()).alias("bad_channel"),
    )
    if not approximate:
        keyed = written(keyed, "transaction-keys")
    date = F.col("t_dat")
    outside = (date < F.lit(min_date).cast("date")) | (date > F.lit(max_date).cast("date"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    ids = {"unique_customers": "customer_id", "unique_articles": "article_id"}
    profile = keyed.agg(
        total("n").alias("row_count"),
        F.min("t_dat").alias("date_min"),
        F.max("t_dat").alias("date_max"),
        *[F.approx_count_distinct(c).alias(name) for name, c in ids.items() if approximate],
        _rows_where(F.col("customer_id").isNull()).alias("null_customer_id"),
        _rows_where(F.col("article_id").isNull()).alias("null_article_id"),
        _rows_where(date.isNull()).alias("null_date"),
        total("bad_channel").alias("invalid_channel"),
        total("null_price").alias("null_price"),
        total("bad_price").alias("non_positive_price"),
        _rows_where(outside).alias("date_out_of_range"),
        _rows_where(~F.col("article_id").rlike(r"^[0-9]+$")).alias("non_numeric_article_id"),
        total(F.col("n") - 1).alias("duplicate_rows"),
    )
    if approximate:
        return profile
    return profile.withColumns({n: keyed.select(c).distinct().agg(F.count(c)).scalar() for n, c in ids.items()})


_TX_ERRORS = ["null_customer_id", "null_article_id", "null_date", "invalid_channel", "null_price", "non_positive_price"]
_TX_WARNINGS = ["date_out_of_range", "non_numeric_article_id", "duplicate_rows"]
_TX_STATS = ["row_count", "date_min", "date_max", "unique_customers", "unique_articles"]


def _findings(profile: DataFrame, table: str, errors: list[str], warnings: list[str]) -> DataFrame:
    """Turn the one-row profile into one row per check that failed."""
    checks = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(severity).alias("severity"),
            F.lit(name).alias("check_name"),
            F.col(f"`{name}`").alias("n_rows"),
        )
        for severity, names in (("error", errors), ("warning", warnings))
        for name in names
    ]
    return profile.select(F.inline(F.array(*checks))).filter(F.col("n_rows") > 0)


def validate_transactions(tx: DataFrame, min_date: str = S.MIN_DATE, max_date: str = S.MAX_DATE) -> DataFrame:
    return _findings(transaction_profile(tx, min_date, max_date), "transactions", _TX_ERRORS, _TX_WARNINGS)


def transaction_stats(tx: DataFrame, approximate: bool = False) -> DataFrame:
    return transaction_profile(tx, approximate=approximate).select(*_TX_STATS)


def invalid_channels(tx: DataFrame) -> DataFrame:
    """The channel values outside the domain (missing counts as one) and their rows."""
    return tx.filter(_bad_channel()).groupBy("sales_channel_id").agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_transactions(tx: DataFrame) -> DataFrame:
    """Keys bought more than once on one day, with the rows beyond the first."""
    keyed = tx.groupBy("customer_id", "article_id", "t_dat").agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
    return keyed.filter(F.col("extra_rows") > 0)


def _dimension_profile(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row: rows, distinct ids, missing and repeated ids, missing values per attribute."""
    keyed = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in attributes]
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return keyed.agg(
        total("n").alias("row_count"),
        F.count(key).alias(f"unique_{key}"),
        _rows_where(F.col(key).isNull()).alias(f"null_{key}"),
        total(F.col("n") - 1).alias(f"duplicate_{key}"),
        *[total(c).alias(f"nulls:{c}") for c in attributes],
    )


_ARTICLE_ATTRIBUTES = [c for c in S.REQUIRED_ARTICLE_COLS if c != "article_id"]


def article_profile(articles: DataFrame) -> DataFrame:
    return _dimension_profile(articles, "article_id", _ARTICLE_ATTRIBUTES)


def customer_profile(customers: DataFrame) -> DataFrame:
    return _dimension_profile(customers, "customer_id", [])


def _null_share(col: str) -> Column:
    return F.coalesce(F.try_divide(F.col(f"`nulls:{col}`"), F.col("row_count")), F.lit(0.0))


def article_null_rates(articles: DataFrame, max_share: float = S.MAX_NULL_SHARE) -> DataFrame:
    """Share of missing values per required attribute, and whether it is over the accepted share."""
    shares = [
        F.struct(F.lit(c).alias("column_name"), _null_share(c).alias("null_share")) for c in _ARTICLE_ATTRIBUTES
    ]
    long = article_profile(articles).select(F.inline(F.array(*shares)))
    return long.withColumn("over_limit", F.col("null_share") > max_share)


def validate_articles(articles: DataFrame, max_share: float = S.MAX_NULL_SHARE) -> DataFrame:
    """Findings on ids, and one warning per attribute with too many missing values."""
    over = {
        f"nulls:{c}": F.when(_null_share(c) > max_share, F.col(f"`nulls:{c}`")).otherwise(F.lit(0))
        for c in _ARTICLE_ATTRIBUTES
    }
    profile = article_profile(articles).withColumns(over)
    return _findings(profile, "articles", ["null_article_id", "duplicate_article_id"], list(over))


def validate_customers(customers: DataFrame) -> DataFrame:
    return _findings(
        customer_profile(customers), "customers", ["null_customer_id", "duplicate_customer_id"], []
    )


def validation_report(tx: DataFrame, articles: DataFrame, customers: DataFrame, **date_range: str) -> DataFrame:
    """All findings of the three tables; an empty result means clean data."""
    return (
        validate_transactions(tx, **date_range)
        .unionByName(validate_articles(articles))
        .unionByName(validate_customers(customers))
    )


# Channel values outside the domain that a report lists.
_LISTED_CHANNELS = 20


def check_transactions(tx: DataFrame, min_date: str = S.MIN_DATE, max_date: str = S.MAX_DATE) -> ValidationReport:
    """The same checks as a driver-side report, with the schema checks that need no job."""
    report = ValidationReport("transactions")
    absent = missing_columns(tx, S.REQUIRED_TRANSACTION_COLS)
    if absent:
        report.errors.append(f"missing required columns: {absent}")
        report.log()
        return report
    if not isinstance(tx.schema["t_dat"].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        report.errors.append("t_dat is not a date column; convert it with to_date first")
        tx = tx.withColumn("t_dat", F.col("t_dat").try_cast("date"))
    row = transaction_profile(tx, min_date, max_date).first().asDict()
    _fill(report, row, _TX_ERRORS, _TX_WARNINGS, _TX_STATS)
    if row["invalid_channel"]:
        # The most frequent ones; the table of invalid_channels has all of them.
        found = invalid_channels(tx)
        report.stats["invalid_channel_kinds"] = found.count()
        most = found.orderBy(F.desc("n_rows"), "sales_channel_id").limit(_LISTED_CHANNELS)
        report.stats["invalid_channel_values"] = [r["sales_channel_id"] for r in most.collect()]
    report.log()
    return report


def check_articles(articles: DataFrame, max_share: float = S.MAX_NULL_SHARE) -> ValidationReport:
    report = ValidationReport("articles")
    absent = missing_columns(articles, S.REQUIRED_ARTICLE_COLS)
    if absent:
        report.errors.append(f"missing required columns: {absent}")
    else:
        row = article_profile(articles).first().asDict()
        _fill(report, row, ["null_article_id", "duplicate_article_id"], [], ["row_count", "unique_article_id"])
        report.warnings += [
            f"column {c} has {row[f'nulls:{c}'] / row['row_count']:.1%} missing values"
            for c in _ARTICLE_ATTRIBUTES
            if row["row_count"] and row[f"nulls:{c}"] / row["row_count"] > max_share
        ]
    report.log()
    return report


def check_customers(customers: DataFrame) -> ValidationReport:
    report = ValidationReport("customers")
    absent = missing_columns(customers, S.REQUIRED_CUSTOMER_COLS)
    if absent:
        report.errors.append(f"missing required columns: {absent}")
    else:
        row = customer_profile(customers).first().asDict()
        _fill(
            report, row, ["null_customer_id", "duplicate_customer_id"], [], ["row_count", "unique_customer_id"]
        )
    report.log()
    return report


def _fill(report: ValidationReport, row: dict, errors: list[str], warnings: list[str], stats: list[str]) -> None:
    report.errors += [f"{row[c]:,} rows fail {c}" for c in errors if row[c]]
    report.warnings += [f"{row[c]:,} rows with {c}" for c in warnings if row[c]]
    report.stats.update({c: row[c] for c in stats})
