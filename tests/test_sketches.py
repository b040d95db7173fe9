"""Sketches per day: exact parts, error bounds, merging in any order, empty and unclean rows."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators import sketches as SK

EXACT = ["row_count", "null_customer_id", "null_article_id", "null_price", "price_min", "price_max", "date_min", "date_max"]


@pytest.fixture(scope="module")
def many(spark):
    """200,000 rows over 40 days, two fifths of them on one, with a distinct customer for every fifth row."""
    n = F.col("id")
    day = F.when(n % 5 < 2, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(40)))
    return spark.range(200_000).select(
        F.date_add(F.lit("2021-03-01").cast("date"), day.cast("int")).alias("t_dat"),
        F.concat(F.lit("c"), (n / 5).cast("long")).alias("customer_id"),
        F.concat(F.lit("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9_000))).alias("article_id"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1_000_000)) / 1000.0).alias("price"),
    )


def exact(tx, start, end):
    rows = tx.filter(F.col("t_dat").between(start, end))
    return rows.toPandas()


@pytest.mark.parametrize(("start", "end"), [("2021-03-01", "2021-05-01"), ("2021-03-05", "2021-03-20"), ("2021-03-08", "2021-03-08")])
def test_any_range_within_its_error(many, start, end):
    days = SK.daily_sketches(many)
    shares = (0.05, 0.5, 0.95)
    got = SK.range_statistics(days, start, end, shares).first()
    rows = exact(many, start, end)
    assert got["row_count"] == len(rows) and got["price_min"] == rows.price.min() and got["price_max"] == rows.price.max()
    assert (got["date_min"], got["date_max"]) == (rows.t_dat.min(), rows.t_dat.max())
    for name, column in (("unique_customers", rows.customer_id), ("unique_articles", rows.article_id)):
        assert got[name] == pytest.approx(column.nunique(), rel=4 * SK.COUNT_ERROR)
    ranks = [(rows.price <= q).mean() for q in got["price_quantiles"]]
    assert ranks == pytest.approx(shares, abs=2 * SK.RANK_ERROR)


def test_parts_added_in_any_order_are_the_whole(many):
    whole = {r["day"]: r for r in SK.statistics(SK.daily_sketches(many), [0.5]).collect()}
    odd = F.col("price") * 1000 % 3 == 0
    parts = [many.filter(odd), many.filter(~odd & (F.col("t_dat") < "2021-03-10")), many.filter(~odd & (F.col("t_dat") >= "2021-03-10"))]
    for order in ([0, 1, 2], [2, 0, 1]):
        days = SK.daily_sketches(parts[order[0]])
        for i in order[1:]:
            days = SK.add_days(days, parts[i])
        got = {r["day"]: r for r in SK.statistics(days, [0.5]).collect()}
        assert got.keys() == whole.keys()
        for day, row in got.items():
            assert [row[c] for c in EXACT[:6]] == [whole[day][c] for c in EXACT[:6]]
            assert row["unique_customers"] == pytest.approx(whole[day]["unique_customers"], rel=4 * SK.COUNT_ERROR)


def test_ranges_do_not_scan_transactions_again(many, tmp_path):
    SK.daily_sketches(many).write.parquet(str(tmp_path / "days"))
    days = many.sparkSession.read.parquet(str(tmp_path / "days"))
    files = SK.range_statistics(days, "2021-03-05", "2021-03-09").inputFiles()
    assert files and all("days" in f for f in files)
    sizes = days.select(sum(F.octet_length(c) for c in ("customers", "articles", "prices")).alias("n")).collect()
    assert max(r["n"] for r in sizes) < 20_000


def test_unclean_rows_and_no_rows(spark):
    day = dt.date(2021, 3, 1)
    rows = [(day, "c", "a", 1.0), (day, "c", "a", 1.0), (day, None, "b", float("nan")), (None, "d", None, 5.0), (dt.date(2021, 3, 2), "e", "b", None)]
    days = SK.daily_sketches(spark.createDataFrame(rows, "t_dat date, customer_id string, article_id string, price double"))
    told = SK.range_statistics(days).first()
    assert [told[c] for c in EXACT] == [5, 1, 1, 2, 1.0, 5.0, day, dt.date(2021, 3, 2)]
    assert (told["unique_customers"], told["unique_articles"]) == (3, 2)
    later = SK.range_statistics(days, "2021-03-02").first()
    assert (later["row_count"], later["null_price"], later["price_quantiles"]) == (1, 1, None)
    nothing = SK.range_statistics(days, "2022-01-01").first()
    assert [nothing[c] for c in EXACT] == [0, 0, 0, 0, None, None, None, None]
    assert (nothing["unique_customers"], nothing["price_quantiles"]) == (0, None)
    with pytest.raises(ValueError, match="not a share"):
        SK.range_statistics(days, quantiles=(1.5,))


def test_error_bounds_are_those_of_the_sizes():
    assert SK.COUNT_ERROR == pytest.approx(1.04 / np.sqrt(4096))
