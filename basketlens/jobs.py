"""Command-line jobs, for ``spark-submit`` or ``python -m basketlens.jobs``.

    marts      staging views and the three mart tables
    train      validate, split, fit both stages, compare, gate, export the model bundle
    recommend  answer a table of requests from an exported bundle
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.functions.columns import article_key, customer_key
from basketlens.operators import marts as M
from basketlens.operators import staging as ST
from basketlens.operators.als import ALSParams
from basketlens.operators.lambdamart import RankerParams
from basketlens.operators.training import TrainingParams, retrain
from basketlens.operators.two_stage import TwoStageRecommender
from basketlens.plans.workspace import drop_session, written
from basketlens.sources import marts as SM
from basketlens.sources import raw as RAW


def build_marts(tx: DataFrame, articles: DataFrame, customers: DataFrame, out: str, as_of: Column) -> None:
    """Register the staging views and write the marts under ``out``. Sales are aggregated once, for all three."""
    views = {
        "stg_transactions": ST.stg_transactions(tx),
        "stg_articles": ST.stg_articles(articles),
        "stg_customers": ST.stg_customers(customers),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    daily = written(M.marked_purchases(views["stg_transactions"]), "daily")
    SM.write_monthly(
        M.interactions_from(daily), f"{out}/fct_user_item_interactions", "transaction_date", ["customer_id", "article_id"]
    )
    users = M.user_mart_from(daily, views["stg_customers"], as_of)
    items = M.item_mart_from(daily, views["stg_articles"], as_of)
    SM.write_clustered(users, f"{out}/fct_user_features", ["customer_id"])
    SM.write_clustered(items, f"{out}/fct_item_features", ["article_id"])


def readable_transactions(raw: DataFrame, out: str) -> DataFrame:
    """The rows that can be read, cleaned; the others go to ``out``/unreadable_transactions with the reason."""
    readable, unreadable = RAW.split_unreadable(raw)
    unreadable.write.mode("overwrite").parquet(f"{out}/unreadable_transactions")
    return RAW.clean_transactions(readable)


def marts_from_raw(tx: DataFrame, articles: DataFrame, customers: DataFrame, out: str, as_of: Column) -> None:
    """The marts of raw tables. Ids of both dimensions are written as those of the transactions are, or they would
    not meet."""
    articles = articles.withColumn("article_id", article_key(F.col("article_id")))
    customers = customers.withColumn("customer_id", customer_key(F.col("customer_id")))
    build_marts(readable_transactions(tx, out), articles, customers, out, as_of)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    for name in ("transactions", "articles", "customers", "out"):
        common.add_argument(f"--{name}", required=True)
    common.add_argument("--format", default="csv", choices=["csv", "parquet", "orc", "json"])
    marts = jobs.add_parser("marts", parents=[common])
    marts.add_argument("--as-of", help="the day recency counts from; today if left out")
    train = jobs.add_parser("train", parents=[common])
    train.add_argument("--rows", type=int, default=0, help="use so many of the latest rows only; 0 for all")
    train.add_argument("--val-start", default=S.VAL_START)
    train.add_argument("--test-start", default=S.TEST_START)
    train.add_argument("--factors", type=int, default=S.ALS_FACTORS)
    train.add_argument("--iterations", type=int, default=40)
    train.add_argument("--regularization", type=float, default=S.ALS_REGULARIZATION)
    train.add_argument("--alpha", type=float, default=S.ALS_ALPHA)
    train.add_argument("--rounds", type=int, default=300)
    train.add_argument("--threshold", type=float, default=S.NDCG_THRESHOLD)
    recommend = jobs.add_parser("recommend")
    for name in ("bundle", "requests", "out"):
        recommend.add_argument(f"--{name}", required=True)
    return parser.parse_args(argv)


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    args = parse()
    spark = SparkSession.builder.appName(f"basketlens-{args.job}").getOrCreate()
    try:
        run(spark, args)
    finally:
        drop_session(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "recommend":
        model = TwoStageRecommender.load(spark, args.bundle)
        answers, refused = model.serve(spark.read.parquet(args.requests))
        answers.write.mode("overwrite").parquet(f"{args.out}/answers")
        refused.write.mode("overwrite").parquet(f"{args.out}/refused")
        return
    if args.job == "marts":
        raw = [RAW.read_table(spark, getattr(args, t), args.format) for t in ("transactions", "articles", "customers")]
        as_of = F.lit(args.as_of).cast("date") if args.as_of else F.current_date()
        marts_from_raw(*raw, args.out, as_of)
        return
    tx = readable_transactions(RAW.read_table(spark, args.transactions, args.format), args.out)
    if args.rows:
        tx = RAW.latest_transactions(tx, args.rows)
    # Files cover ranges of days, so that date windows skip files.
    tx = written(tx.repartitionByRange("t_dat", "customer_id"), "transactions")
    params = TrainingParams(
        val_start=args.val_start,
        test_start=args.test_start,
        als=ALSParams(args.factors, args.iterations, args.regularization, args.alpha),
        ranker=RankerParams(n_rounds=args.rounds),
    )
    articles = RAW.load_articles(spark, args.articles, args.format)
    customers = RAW.load_customers(spark, args.customers, args.format)
    retrain(tx, articles, customers, args.out, params, args.threshold).show()


if __name__ == "__main__":
    main()
