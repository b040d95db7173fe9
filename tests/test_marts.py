"""Staging and marts on small tables, and the marts job."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from basketlens import jobs
from basketlens import schemas as S
from basketlens.operators import marts as M
from basketlens.operators import staging as ST
from basketlens.plans.workspace import written



def as_of():
    return F.lit("2020-02-01").cast("date")


@pytest.fixture(scope="module")
def tx(make_tx):
    return make_tx(
        [
            ("2020-01-01", "u1", "a1", 1.0, 1),
            ("2020-01-01", "u1", "a1", 3.0, 2),
            ("2020-01-04", "u1", "a2", 2.0, 1),
            ("2020-01-05", "u2", "a1", 4.0, 1),
            ("2020-01-05", "u2", "a1", 0.0, 1),
            ("2020-01-05", None, "a1", 4.0, 1),
            ("2020-01-05", "u2", None, 4.0, 1),
            ("2020-01-05", "u3", "a1", None, 1),
            ("2020-01-05", "u3", "a1", float("nan"), 1),
        ]
    )


@pytest.fixture(scope="module")
def articles(spark):
    rows = [(f"a{i}", *["x"] * (len(S.STAGED_ARTICLE_COLS) - 1)) for i in (1, 2, 3)]
    return spark.createDataFrame(rows, S.STAGED_ARTICLE_COLS)


@pytest.fixture(scope="module")
def customers(spark):
    rows = [("u1", 24.6, "ACTIVE", "NONE", True), ("u9", None, "ACTIVE", "NONE", None)]
    return spark.createDataFrame(
        rows, "customer_id string, age double, club_member_status string, fashion_news_frequency string, active boolean"
    )


def test_staging_drops_unusable_rows_and_adds_calendar(tx):
    rows = ST.stg_transactions(tx).orderBy("transaction_date", "price").collect()
    assert [r["price"] for r in rows] == [1.0, 3.0, 2.0, 4.0]
    # 2020-01-05 is the first Sunday of its year.
    assert [(r["transaction_year"], r["transaction_month"], r["transaction_week"]) for r in rows] == [
        (2020, 1, 0),
        (2020, 1, 0),
        (2020, 1, 0),
        (2020, 1, 1),
    ]


def test_customer_ages_are_rounded_and_bucketed(customers):
    rows = {r["customer_id"]: r for r in ST.stg_customers(customers).collect()}
    assert (rows["u1"]["age"], rows["u1"]["age_bucket"], rows["u1"]["is_active"]) == (25, "25_34", True)
    assert (rows["u9"]["age"], rows["u9"]["age_bucket"]) == (None, "50_plus")


@pytest.mark.parametrize(("text", "flag"), [("1.0", True), ("0", False), ("true", True), (None, None), ("?", None)])
def test_active_flag_from_text(spark, text, flag):
    df = spark.createDataFrame(
        [("u", "31", "A", "N", text)],
        "customer_id string, age string, club_member_status string, fashion_news_frequency string, Active string",
    )
    row = ST.stg_customers(df).first()
    assert (row["is_active"], row["age"]) == (flag, 31)


def test_interactions(tx):
    rows = {(r["customer_id"], r["article_id"]): r for r in M.fct_user_item_interactions(ST.stg_transactions(tx)).collect()}
    assert len(rows) == 3
    assert rows["u1", "a1"]["purchase_count"] == 2
    assert rows["u1", "a1"]["total_spend"] == 4.0
    assert rows["u1", "a1"]["implicit_confidence"] == pytest.approx(1.6931471805599454)
    assert rows["u2", "a1"]["implicit_confidence"] == 1.0


def test_user_mart(tx, customers):
    rows = {
        r["customer_id"]: r
        for r in M.fct_user_features(ST.stg_transactions(tx), ST.stg_customers(customers), as_of()).collect()
    }
    u1 = rows["u1"]
    assert (u1["total_unique_items"], u1["total_purchases"], u1["total_spend"], u1["avg_item_price"]) == (2, 3, 6.0, 2.0)
    # Distinct days, not the span between first and last.
    assert (u1["active_days"], u1["days_since_last_purchase"]) == (2, 28)
    assert u1["first_purchase_date"] == dt.date(2020, 1, 1)
    assert (rows["u2"]["age"], rows["u2"]["total_purchases"]) == (None, 1)
    assert set(rows) == {"u1", "u2"}


def test_articles_and_buyers_are_counted_without_moving_the_pairs(spark, make_tx, customers, articles):
    # One customer with most sales, on days that repeat across articles; one article that all customers buy.
    rows = [(f"2020-01-{1 + i % 7:02d}", "u1", f"a{i % 40}", 1.0) for i in range(400)]
    rows += [("2020-01-09", f"u{i}", "a1", 2.0) for i in range(2, 60)] * 2 + [(None, "u2", "a1", 1.0)]
    stg = ST.stg_transactions(make_tx(rows))
    daily = written(M.marked_purchases(stg), "daily")
    assert daily.where("first_of_pair").count() == daily.select("customer_id", "article_id").distinct().count() == 98
    users = M.user_mart_from(daily, ST.stg_customers(customers), as_of())
    found = {r["customer_id"]: (r["total_unique_items"], r["total_purchases"], r["active_days"]) for r in users.collect()}
    assert found == {"u1": (40, 400, 7), "u2": (1, 3, 1)} | {f"u{i}": (1, 2, 1) for i in range(3, 60)}
    items = {r["article_id"]: r for r in M.item_mart_from(daily, ST.stg_articles(articles), as_of()).collect()}
    assert [(items[a]["unique_buyers"], items[a]["total_purchases"]) for a in ("a1", "a2")] == [(59, 127), (1, 10)]
    # Sales move aggregated by day, by ranges of (customer, article), and never again by the pair.
    plan = M.marked_purchases(stg)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange (\w+)", plan) == ["rangepartitioning", "hashpartitioning"]
    assert plan.index("rangepartitioning") < plan.index("partial_count(1)")
    assert not re.search(r"hashpartitioning\(customer_id#\d+, article_id", users._jdf.queryExecution().executedPlan().toString())


def test_item_mart_keeps_unsold_articles(tx, articles):
    rows = {
        r["article_id"]: r
        for r in M.fct_item_features(ST.stg_transactions(tx), ST.stg_articles(articles), as_of()).collect()
    }
    assert (rows["a1"]["unique_buyers"], rows["a1"]["total_purchases"], rows["a1"]["popularity_score"]) == (2, 3, 1.0)
    assert rows["a1"]["avg_price"] == pytest.approx(8 / 3)
    assert rows["a2"]["popularity_score"] == 0.5
    assert (rows["a3"]["unique_buyers"], rows["a3"]["avg_price"], rows["a3"]["last_sold_date"]) == (0, 0.0, None)
    assert rows["a3"]["popularity_score"] == 0.0


def test_no_sales_at_all_gives_no_score(make_tx, articles):
    rows = M.fct_item_features(ST.stg_transactions(make_tx([])), ST.stg_articles(articles), as_of()).collect()
    assert [r["popularity_score"] for r in rows] == [None] * 3


def test_marts_job_writes_the_same_tables(spark, tx, articles, customers, tmp_path):
    jobs.build_marts(tx, articles, customers, str(tmp_path), as_of())
    stg = ST.stg_transactions(tx)
    want = {
        "fct_user_item_interactions": M.fct_user_item_interactions(stg),
        "fct_user_features": M.fct_user_features(stg, ST.stg_customers(customers), as_of()),
        "fct_item_features": M.fct_item_features(stg, ST.stg_articles(articles), as_of()),
    }
    for name, df in want.items():
        back = spark.read.parquet(f"{tmp_path}/{name}").select(df.columns)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())), name
    assert spark.table("stg_transactions").count() == 4
    plan = spark.read.parquet(f"{tmp_path}/fct_user_item_interactions").filter("month = '2020-01-01'")
    assert plan.count() == 3


def test_marts_from_csv_files(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(
        "t_dat,customer_id,article_id,price,sales_channel_id\n2020-01-01, U1 ,663713001,0.05,2\n"
    )
    header = ",".join(["product_code", *S.STAGED_ARTICLE_COLS])
    (tmp_path / "art.csv").write_text(f"{header}\n9, 663713001,{','.join('x' * 9)}\n")
    (tmp_path / "cust.csv").write_text(
        "customer_id,FN,Active,club_member_status,fashion_news_frequency,age\n U1,,1.0,ACTIVE,NONE,24\n"
    )
    args = jobs.parse(
        ["marts", "--transactions", f"{tmp_path}/tx.csv", "--articles", f"{tmp_path}/art.csv"]
        + ["--customers", f"{tmp_path}/cust.csv", "--out", f"{tmp_path}/out", "--as-of", "2020-01-31"]
    )
    jobs.run(spark, args)
    user = spark.read.parquet(f"{tmp_path}/out/fct_user_features").first()
    assert (user["customer_id"], user["age_bucket"], user["is_active"]) == ("u1", "under_25", True)
    assert user["days_since_last_purchase"] == 30
    item = spark.read.parquet(f"{tmp_path}/out/fct_item_features").first()
    assert (item["article_id"], item["unique_buyers"], item["popularity_score"]) == ("0663713001", 1, 1.0)
