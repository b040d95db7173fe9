"""Metrics against a list-based computation, evaluation, comparison, lift, gate, sampling."""

from __future__ import annotations

import math
import random

import pytest

from basketlens.operators import evaluate as E
from basketlens.operators import metrics as ME
from basketlens.operators import popularity as P
from basketlens.operators import split as SP


def tables(spark, recs, truth):
    rec_rows = [(u, a, i + 1) for u, items in recs.items() for i, a in enumerate(items)]
    truth_rows = [(u, a) for u, items in truth.items() for a in items]
    return (
        spark.createDataFrame(rec_rows, "customer_id string, article_id string, rank int"),
        spark.createDataFrame(truth_rows, "customer_id string, article_id string"),
    )


def scores(spark, recs, truth, k):
    return {r["customer_id"]: r for r in ME.per_user_metrics(*tables(spark, recs, truth), k).collect()}


def expected(items, relevant, k):
    flags = [a in relevant for a in items[:k]]
    dcg = sum(1 / math.log2(i + 2) for i, f in enumerate(flags) if f)
    ideal = sum(1 / math.log2(i + 2) for i in range(min(len(relevant), k)))
    hits, prec = 0, 0.0
    for i, f in enumerate(flags):
        if f:
            hits += 1
            prec += hits / (i + 1)
    return dcg, dcg / ideal, sum(flags) / len(relevant), prec / min(len(relevant), k), float(any(flags))


def test_known_values(spark):
    got = scores(
        spark,
        {"perfect": ["a", "b", "c"], "partial": ["a", "x", "b"], "half": ["a", "x", "y"], "none": ["x", "y"]},
        {"perfect": "abc", "partial": "ab", "half": "ab", "none": "ab", "unlisted": "a"},
        3,
    )
    assert got["perfect"]["ndcg"] == pytest.approx(1.0)
    assert got["perfect"]["map"] == pytest.approx(1.0)
    assert got["perfect"]["recall"] == 1.0
    assert got["partial"]["ndcg"] == pytest.approx(0.9197207891)
    assert got["half"]["recall"] == 0.5
    assert got["none"]["ndcg"] == 0.0
    # A customer with true articles but no list counts with zeros.
    assert tuple(got["unlisted"][m] for m in ("dcg", "ndcg", "recall", "map", "hit_rate")) == (0.0,) * 5


def test_position_matters(spark):
    got = scores(spark, {"top": ["a", "x", "y"], "bottom": ["x", "y", "a"]}, {"top": "a", "bottom": "a"}, 3)
    assert got["top"]["ndcg"] > got["bottom"]["ndcg"]


@pytest.mark.parametrize("k", [1, 5, 10])
def test_random_lists_equal_list_computation(spark, k):
    rnd = random.Random(11)
    items = [f"a{i}" for i in range(30)]
    recs = {f"u{i}": rnd.sample(items, rnd.randrange(0, 16)) for i in range(60)}
    truth = {f"u{i}": rnd.sample(items, rnd.randrange(1, 25)) for i in range(60)}
    got = scores(spark, recs, truth, k)
    assert len(got) == 60
    for u, relevant in truth.items():
        row = tuple(got[u][m] for m in ("dcg", "ndcg", "recall", "map", "hit_rate"))
        assert row == pytest.approx(expected(recs[u], set(relevant), k))


def test_means_over_nobody_are_zero(spark):
    recs, truth = tables(spark, {"u": ["a"]}, {"u": "a"})
    row = ME.mean_metrics(ME.per_user_metrics(recs, truth.limit(0), 10)).first()
    assert row.asDict() == {"ndcg": 0.0, "recall": 0.0, "map": 0.0, "hit_rate": 0.0, "n_users": 0}


def test_k_must_be_positive(spark):
    with pytest.raises(ValueError, match="k must"):
        ME.hits_at_k(*tables(spark, {"u": ["a"]}, {"u": "a"}), 0)


@pytest.fixture(scope="module")
def split(make_tx):
    return SP.make_temporal_split(
        make_tx(
            [
                ("2020-01-01", "u1", "a1"),
                ("2020-01-05", "u2", "a2"),
                ("2020-01-10", "u1", "a3"),
                ("2020-07-01", "u1", "a2"),
                ("2020-07-02", "u2", "a1"),
                ("2020-08-15", "u1", "a1"),
                ("2020-08-20", "u4", "a5"),
            ]
        ),
        "2020-07-01",
        "2020-08-12",
    )


def test_evaluate(split):
    model = P.PopularityModel.fit(split.train)
    test = E.EvalReport.from_row(E.evaluate(model, split, "test").first())
    assert (test.split, test.k, test.n_users, test.cold_start_n, test.cold_start_rate) == ("test", 10, 1, 1, 0.5)
    # u1's only true article was bought before, so it is not listed.
    assert (test.ndcg, test.recall, test.map) == (0.0, 0.0, 0.0)
    again = E.EvalReport.from_row(E.evaluate(model, split, "test", exclude_seen=False).first())
    assert (again.ndcg, again.recall) == (1.0, 1.0)
    val = E.EvalReport.from_row(E.evaluate(model, split, "val", k=5).first())
    assert (val.k, val.n_users, val.cold_start_n) == (5, 2, 0)
    # u1 is listed [a2], u2 [a1, a3]: both find their article first.
    assert (val.ndcg, val.recall, val.map) == (1.0, 1.0, 1.0)
    text = test.summary()
    assert all(word in text for word in ("test at", "ndcg", "no training purchase"))
    with pytest.raises(ValueError, match="which"):
        E.evaluate(model, split, "train")


def test_compare_lift_and_gate(spark):
    recs_a, truth = tables(spark, {"u": ["a", "b"], "v": ["x", "y"]}, {"u": "a", "v": "y", "w": "q"})
    recs_b, _ = tables(spark, {"u": ["z", "a"], "v": ["y", "x"]}, {"u": "a"})
    table = E.compare_models({"one": recs_a, "two": recs_b}, {"val": truth, "test": truth.filter("customer_id <> 'w'")})
    rows = {(r["model"], r["split"]): r for r in table.collect()}
    assert set(rows) == {(m, s) for m in ("one", "two") for s in ("val", "test")}
    assert rows["one", "val"]["n_users"] == 3
    assert rows["one", "test"]["n_users"] == 2
    assert rows["one", "test"]["ndcg"] == pytest.approx((1 + 1 / math.log2(3)) / 2)
    assert rows["one", "val"]["recall"] == pytest.approx(2 / 3)
    lift = {(r["model"], r["split"]): r for r in E.metric_lift(table, "one").collect()}
    assert lift["one", "val"]["recall_lift"] == 0.0
    assert lift["two", "test"]["ndcg_lift"] == pytest.approx(0.0)
    gate = {(r["model"], r["split"]): r["promoted"] for r in E.promotion_gate(table, 0.6).collect()}
    assert gate == {("one", "val"): False, ("one", "test"): True, ("two", "val"): False, ("two", "test"): True}


def test_sample_users_repeats_whatever_the_partitioning(spark):
    users = spark.range(0, 1000).selectExpr("cast(id % 300 as string) AS customer_id")
    first = {r[0] for r in E.sample_users(users, 40, 5).collect()}
    assert len(first) == 40
    assert first == {r[0] for r in E.sample_users(users.repartition(9), 40, 5).collect()}
    assert first != {r[0] for r in E.sample_users(users, 40, 6).collect()}
    assert E.sample_users(users, 5000, 5).count() == 300
