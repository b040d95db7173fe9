"""Every registered query against its SQL counterpart on the smallest tables; invariants of the others."""

from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from basketlens import schemas as S
from basketlens.operators.lambdamart import RankerParams
from basketlens.registry import queries as Q
from basketlens.registry.oracle import all_oracles
from basketlens.registry.queries import all_queries
from compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()
LEARNED = {
    "als_candidates",
    "lambdamart_rank",
    "feature_importance",
    "two_stage_recommend",
    "evidence_run",
    "als_grid",
    "als_halving",
}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="the shared test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_point_has_every_query_and_counterpart():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_only_learned_results_lack_sql():
    assert set(QUERIES) - set(ORACLES) == LEARNED
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_learned_queries_are_as_patient_as_the_library():
    assert Q.TRAINING.ranker.early_stopping_rounds == RankerParams().early_stopping_rounds == 50


def test_entry_gives_lists_for_known_customers(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["customer_id", "article_id", "rank"]
    per_user = df.groupBy("customer_id").agg(F.count("*").alias("n"), F.max("rank").alias("top")).collect()
    assert per_user
    assert all(r["n"] == r["top"] == 10 for r in per_user)


def test_als_candidates_keep_their_promises(spark):
    models = Q.trained(spark, SF)
    recs = Q.als_candidates(spark, SF).cache()
    assert recs.join(models.two_stage.seen, ["customer_id", "article_id"], "left_semi").count() == 0
    assert recs.select("customer_id", "article_id").distinct().count() == recs.count()
    bought = models.two_stage.seen.groupBy("customer_id").agg(F.count("*").alias("bought"))
    sizes = recs.groupBy("customer_id").agg(F.count("*").alias("n"), F.max("als_rank").alias("last"))
    n_items = models.als.n_items
    for r in sizes.join(bought, "customer_id").collect():
        assert r["n"] == min(S.N_CANDIDATES, n_items - r["bought"])
        assert r["last"] == r["n"] - 1


def test_two_stage_serves_every_customer(spark):
    recs = Q.two_stage_recommend(spark, SF).cache()
    buyers = Q.trained(spark, SF).split.transactions.select("customer_id").distinct().count()
    per_user = recs.groupBy("customer_id").agg(F.count("*").alias("n"), F.count_distinct("source").alias("s"))
    rows = per_user.collect()
    assert len(rows) == buyers
    assert all(r["n"] == 10 and r["s"] == 1 for r in rows)
    assert {r[0] for r in recs.select("source").distinct().collect()} == {"als+lgbm", "popularity"}


def test_evidence_run_compares_three_models_on_the_same_customers(spark):
    rows = Q.evidence_run(spark, SF).collect()
    assert len(rows) == 6
    assert len({r["n_users"] for r in rows if r["split"] == "test"}) == 1
