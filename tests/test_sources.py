"""Loaders, the latest-rows selection, id normalisation, sinks and the missing-source guard."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.functions import columns as C
from basketlens.plans import numbering
from basketlens.sources import marts, raw


def test_missing_source_says_what_to_do(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Required data not found"):
        raw.load_articles(spark, str(tmp_path / "none.csv"))


def test_csv_loaders_read_by_column_name(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "customer_id,FN,Active,club_member_status,fashion_news_frequency,age,postal_code\n"
        " ABc1 ,1,1,ACTIVE,NONE,24,x\n"
    )
    row = raw.load_customers(spark, str(tmp_path / "customers.csv")).first()
    assert row.asDict() == {
        "customer_id": "abc1",
        "age": "24",
        "club_member_status": "ACTIVE",
        "fashion_news_frequency": "NONE",
    }
    (tmp_path / "articles.csv").write_text(
        "article_id,product_code,product_type_name,product_group_name,colour_group_name,department_name,detail_desc\n"
        '108775015,108775,Vest top,Garment Upper body,Black,Jersey Basic,"Jersey, top"\n'
    )
    row = raw.load_articles(spark, str(tmp_path / "articles.csv")).first()
    assert row["article_id"] == "0108775015"
    assert row["detail_desc"] == "Jersey, top"
    assert "product_code" not in row.asDict()


def test_transactions_from_csv(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(
        "t_dat,customer_id,article_id,price,sales_channel_id\n"
        "2020-01-01, U1 ,663713001,0.0508,2\n2020-01-02,u2,0541518023,0.0305,1\n2020-01-03,u3,1,NaN,1\n"
    )
    tx = raw.load_transactions(spark, str(tmp_path / "tx.csv"))
    assert dict(tx.dtypes) == {
        "t_dat": "date",
        "customer_id": "string",
        "article_id": "string",
        "price": "double",
        "sales_channel_id": "int",
    }
    rows = sorted(tx.collect())
    assert rows[0][1:] == ("u1", "0663713001", 0.0508, 2)
    assert rows[2]["price"] is None
    assert raw.load_transactions(spark, str(tmp_path / "tx.csv"), n_rows=2).count() == 2


def test_unreadable_date_raises_or_is_set_aside(spark):
    rows = spark.createDataFrame(
        [("2020-01-01", "u", "a", "1.0", "1"), ("garbage", "u", "a", "1.0", "1"), ("2020-01-01", "u", "a", "x", "1")],
        "t_dat string, customer_id string, article_id string, price string, sales_channel_id string",
    )
    with pytest.raises(Exception, match="garbage"):
        raw.clean_transactions(rows.filter("price = '1.0'")).collect()
    good, bad = raw.split_unreadable(rows)
    assert raw.clean_transactions(good).count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["price", "t_dat"]


@pytest.mark.parametrize("n", [1, 7, 50, 149, 150, 1000])
@pytest.mark.parametrize("parallel", [False, True])
def test_latest_transactions_equals_sorted_tail(spark, make_tx, monkeypatch, n, parallel):
    if parallel:
        monkeypatch.setattr(numbering, "ORDERED_LIMIT_ROWS", 0)
    # One day holds a third of all rows.
    day = dt.date(2020, 1, 1)
    rows = [
        ((day + dt.timedelta(days=3 if i % 3 == 0 else i % 9)).isoformat(), f"u{i % 13}", f"a{i}", float(i))
        for i in range(150)
    ]
    got = raw.latest_transactions(make_tx(rows), n).collect()
    want = sorted(rows, key=lambda r: (-dt.date.fromisoformat(r[0]).toordinal(), r[1], r[2]))[:n]
    assert sorted(r["article_id"] for r in got) == sorted(r[2] for r in want)


def test_latest_transactions_needs_a_positive_size(make_tx):
    with pytest.raises(ValueError, match="at least 1"):
        raw.latest_transactions(make_tx([("2020-01-01", "u", "a")]), 0)


def test_ids_are_stripped_as_by_the_pattern(spark):
    ends = ["", " ", "\t", "\n", "\x0b", "\f", "\r", "\r\n", "\x85", " \x85", " \u2028", "\u2029 ", "\xa0", " \n\u2028"]
    ids = spark.createDataFrame([(a + mid + b,) for a in ends for mid in ("", "x", "x y\t0", "0" * 12) for b in ends], "a string")
    pattern = F.regexp_replace("a", r"^\s+|\s+$", "")
    key = F.when(F.length(pattern) < 10, F.lpad(pattern, 10, "0")).otherwise(pattern)
    assert ids.where(~C.stripped(F.col("a")).eqNullSafe(pattern) | ~C.article_key(F.col("a")).eqNullSafe(key)).count() == 0
    plan = ids.select(C.article_key(F.col("a")))._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" in plan


def test_ids_are_stripped_of_any_white_space_and_never_cut(spark):
    ids = spark.createDataFrame([("\t42 \n", " 123456789012 "), ("0000000007", "Ab C ")], "a string, b string")
    rows = ids.select(C.article_key(F.col("a")), C.article_key(F.col("b")), C.customer_key(F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [
        ("0000000042", "123456789012", "123456789012"),
        ("0000000007", "000000Ab C", "ab c"),
    ]


def test_sunday_week_equals_strftime(spark):
    days = [dt.date(2018, 1, 1) + dt.timedelta(days=i) for i in range(0, 1826)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", C.sunday_week(F.col("d")).alias("w"))
    assert all(r["w"] == int(r["d"].strftime("%U")) for r in got.collect())


def test_position_score_rounds_half_even(spark):
    row = spark.range(1).select(C.position_score(F.lit(3), F.lit(32)), C.position_score(F.lit(0), F.lit(0))).first()
    assert tuple(row) == (0.9062, 1.0)


def test_write_table_replaces_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert raw.write_table(spark.range(10), path) == {"rows_in": 10, "rows_out": 10}
    assert raw.write_table(spark.range(4), path) == {"rows_in": 4, "rows_out": 4}


def test_monthly_mart_spreads_a_hot_month(spark, tmp_path):
    df = spark.range(0, 20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2020-05-07")).otherwise(F.lit("2020-02-01")).cast("date").alias("day"),
        (F.col("id") % 977).cast("string").alias("customer_id"),
    )
    # The data are tiny, so keep the runtime from merging the shuffle partitions into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marts.write_monthly(df, str(tmp_path / "m"), "day", ["customer_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(str(tmp_path / "m"))
    assert back.count() == 20_000
    assert sorted(str(r[0]) for r in back.select("month").distinct().collect()) == ["2020-02-01", "2020-05-01"]
    files = back.filter("month = '2020-02-01'").select(F.input_file_name()).distinct().count()
    assert files > 1
    marts.write_clustered(df, str(tmp_path / "c"), ["customer_id"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 20_000


def test_bucketed_table_is_found_again(spark, tmp_path):
    path = str(tmp_path / "buckets")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 7).alias("n"))
    marts.write_bucketed(rows.limit(10), path, "customer_id", 4)
    marts.write_bucketed(rows, path, "customer_id", 4)
    marts.forget_bucketed(spark, path)
    back = marts.read_bucketed(spark, path, "customer_id", 4)
    assert back.schema.simpleString() == rows.schema.simpleString() and back.exceptAll(rows).isEmpty() and back.count() == 1000
    # One file per bucket, read by one task each; counting per key needs no exchange.
    assert len(back.inputFiles()) == 4
    plan = back.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    marts.write_bucketed(rows.limit(0), path, "customer_id", 4)
    assert spark.read.schema(rows.schema).parquet(path).count() == 0
    assert marts.bucket_count(spark, 10) == 4 and marts.bucket_count(spark, 1_000_000) == 20


def test_ids_are_written_out_after_the_rows_have_moved(spark, tmp_path):
    from basketlens.sources import fixtures as X

    spark.sql("SELECT 7L o_orderkey, 12L o_custkey, TIMESTAMP_NTZ'1999-01-02' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    lines = "SELECT 7L l_orderkey, 1L l_linenumber, 345L l_partkey, 9.5D l_extendedprice UNION ALL SELECT 7L, 2L, NULL, 1D"
    spark.sql(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = X._order_lines(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "lpad" in plan.split("RepartitionByExpression")[0] and "lpad" not in plan.split("RepartitionByExpression")[1]
    got = {(r["customer_id"], r["article_id"], str(r["price"]), r["sales_channel_id"]) for r in rows.collect()}
    assert got == {("0000000012", "0000000345", "9.50", 2), ("0000000012", None, "1.00", 2)}
