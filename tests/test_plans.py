"""Numbering, first-n and lookup joins against plain Spark or Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from basketlens.plans import numbering, skew, workspace


def test_number_rows_is_dense_and_ordered(spark):
    values = random.Random(1).sample(range(100_000), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = {r["v"]: r["pos"] for r in numbering.number_rows(df, [F.desc("v")], "pos").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values, reverse=True))}


def _mixed(spark):
    """Ties, nulls, signs, long and short texts, days and repeated rows."""
    i = F.col("id")
    return spark.range(0, 3000).select(
        (F.hash("id") % 50).alias("k"),
        F.when(i % 7 != 0, (F.hash("id") * 1.5 - 1e6).cast("double")).alias("x"),
        F.when(i % 11 != 0, F.substring(F.md5((i % 900).cast("string")), 1, (i % 5 * 8).cast("int"))).alias("s"),
        F.date_add(F.lit("2020-01-01"), (F.hash("id") % 400).cast("int")).alias("d"),
        "id",
    )


@pytest.mark.parametrize("order", [["k", "id"], ["x", "id"], ["s", "k", "id"], ["d", "s", "id"], ["id"]])
@pytest.mark.parametrize("n", [1, 99, 2999, 5000])
def test_selected_rows_equal_the_ordered_limit(spark, monkeypatch, n, order):
    df = _mixed(spark)
    want = {r["id"] for r in df.orderBy(*order).limit(n).collect()}
    monkeypatch.setattr(numbering, "ORDERED_LIMIT_ROWS", 7)
    monkeypatch.setattr(numbering, "_BUCKETS", 8)
    first = numbering.first_rows(df, order, n)
    got = [r["id"] for r in first.collect()]
    assert len(got) == min(n, 3000)
    assert set(got) == want
    # The rows themselves are neither sorted nor written, but for the last bucket.
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan.split("Union")[0]


def test_equal_rows_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ORDERED_LIMIT_ROWS", 7)
    same = spark.range(500).select(F.lit(1).alias("a"), F.lit("x").alias("s"))
    assert numbering.first_rows(same, ["a", "s"], 123).count() == 123
    assert numbering.first_rows(same.limit(0), ["a", "s"], 123).count() == 0
    odd = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (float("inf"),), (-2.0,)] * 30, "x double")
    got = sorted(str(r["x"]) for r in numbering.first_rows(odd, ["x"], 100).collect())
    assert got == sorted(str(r["x"]) for r in odd.orderBy("x").limit(100).collect())


def test_nth_value(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ORDERED_LIMIT_ROWS", 7)
    df = _mixed(spark)
    for name in ("id", "s", "x", "d"):
        values = [r[0] for r in df.select(name).orderBy(name).collect()]
        for n in (0, 1, 700, 2999):
            assert numbering.nth_value(df, name, n) == values[n]
        assert numbering.nth_value(df, name, 3000) is None


def _skewed(spark):
    """A third of the rows on one key, some without a key, some with a key the lookup lacks."""
    return spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
        .alias("key"),
        "id",
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize(("max_rows", "hot_keys", "given"), [(10_000, 10, False), (10, 5, False), (10, 1000, True)])
def test_lookup_join_equals_plain_join(spark, how, max_rows, hot_keys, given):
    rows = _skewed(spark)
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(300)], "key string, v int")
    frequent = skew.frequent_keys(rows, "key", hot_keys) if given else None
    got = skew.lookup_join(rows, lookup, "key", how, frequent, max_rows)
    want = rows.join(lookup, "key", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_hot_rows_are_spread(spark, monkeypatch):
    """A key with a third of the rows does not end up in one shuffle partition."""
    monkeypatch.setattr(skew, "SALTS", 16)
    rows, lookup = _skewed(spark), spark.range(400).selectExpr("concat('k', id) AS key", "id AS v")
    lookup = lookup.unionByName(spark.createDataFrame([("hot", -1)], "key string, v long"))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in confs.items():
        spark.conf.set(name, value)
    try:
        joined = skew.lookup_join(rows, lookup, "key", "left", max_rows=10)
        parts = joined.filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in confs:
            spark.conf.unset(name)
    assert sum(r["count"] for r in parts) == 3000
    assert len(parts) == 4


def test_lookup_join_rejects_other_joins(spark):
    with pytest.raises(ValueError, match="how"):
        skew.lookup_join(spark.range(1), spark.range(1), "id", "full")


def test_written_and_dropped(spark):
    df = workspace.written(spark.range(10), "probe")
    assert df.count() == 10
    files = df.inputFiles()
    assert files
    workspace.drop_written(df)
    with pytest.raises(Exception, match="(?i)exist|found"):
        spark.read.parquet(files[0]).count()


def test_session_folder_is_named_by_the_application(spark):
    path = workspace.scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in path
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or path.startswith(folder)


def test_drop_refuses_other_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="not a written"):
        workspace.drop_written(spark.read.parquet(str(tmp_path / "t")))


def test_the_part_of_a_large_lookup_that_is_asked_for_is_broadcast(spark):
    lookup = workspace.written(spark.range(1000).select("id", (F.col("id") * 2).alias("twice")), "t-lookup")
    rows = spark.range(500).select((F.col("id") % 7).alias("id"), F.col("id").alias("n"))
    rows = rows.unionByName(spark.createDataFrame([(None, -1), (5000, -2)], "id long, n long"))
    for how in ("left", "inner"):
        joined = skew.lookup_join(rows, lookup, "id", how, max_rows=20)
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, rows.join(lookup, "id", how).collect()), key=str)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
