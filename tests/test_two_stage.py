"""Both stages end to end: routing, batch answers, bundle, training run and gate."""

from __future__ import annotations

import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketlens.operators import als as A
from basketlens.operators import lambdamart as L
from basketlens.operators import training as PL
from basketlens.operators import two_stage as TS
from basketlens.operators.validate import DataValidationError
from basketlens.sources import bundle as B
from basketlens.sources import marts as SM


@pytest.fixture(scope="module")
def tx(make_tx):
    """Forty customers with a taste for one half of thirty articles, over ten days."""
    rnd = random.Random(4)
    start, rows = dt.date(2020, 1, 1), []
    for u in range(40):
        for d in range(10):
            for _ in range(2):
                item = rnd.randrange(15) + (15 if u % 2 else 0) if rnd.random() < 0.8 else rnd.randrange(30)
                rows.append(((start + dt.timedelta(days=d)).isoformat(), f"u{u:02d}", f"{item:010d}", 1.0 + item, 1 + d % 2))
    rows += [("2020-01-10", "late", f"{i:010d}", 1.0, 1) for i in range(3)]
    return make_tx(rows)


PARAMS = PL.TrainingParams(
    val_start="2020-01-08",
    test_start="2020-01-10",
    n_candidates=15,
    max_negatives=8,
    als=A.ALSParams(factors=4, iterations=3),
    ranker=L.RankerParams(n_rounds=3, learning_rate=0.3, min_leaf_rows=2, leaves=8),
)


@pytest.fixture(scope="module")
def models(tx):
    return PL.train_models(tx, PARAMS)


@pytest.fixture(scope="module")
def two(models):
    return models.two_stage


def users(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "customer_id string")


def test_known_and_cold_customers(spark, two, lists):
    recs = two.recommend(users(spark, "u01", "u02", "ghost"), 5).cache()
    got = lists(recs)
    assert set(got) == {"u01", "u02", "ghost"}
    assert all(len(v) == len(set(v)) == 5 for v in got.values())
    sources = {r["customer_id"]: r["source"] for r in recs.collect()}
    assert sources == {"u01": TS.RANKED, "u02": TS.RANKED, "ghost": TS.POPULAR}
    assert got["ghost"] == [r["article_id"] for r in two.popularity.top_k(5).orderBy("pop_rank").collect()]
    seen = two.seen.filter("customer_id = 'u01'").collect()
    assert not {r["article_id"] for r in seen} & set(got["u01"])


def test_one_customer_gets_the_same_as_in_a_batch(spark, two, lists):
    batch = lists(two.recommend(users(spark, "u01", "u02", "u03", "ghost"), 5))
    assert lists(two.recommend(users(spark, "u03"), 5)) == {"u03": batch["u03"]}


def test_seen_articles_can_stay(spark, two):
    ranked = two.rerank(users(spark, "u01"), 15, exclude_seen=False)
    assert ranked.count() == 15
    seen = two.seen.filter("customer_id = 'u01'")
    assert ranked.join(seen, ["customer_id", "article_id"], "left_semi").count() > 0


def test_is_known_user(spark, two):
    rows = {r["customer_id"]: r["known"] for r in two.is_known_user(users(spark, "u01", "ghost")).collect()}
    assert rows == {"u01": True, "ghost": False}


def test_customer_who_bought_everything_is_routed_by_what_they_get(spark, make_tx, lists):
    """A customer without candidates is labelled with the list they really get."""
    from basketlens.operators.popularity import PopularityModel

    model = PopularityModel.fit(make_tx([("2020-01-01", "u", "a"), ("2020-01-01", "v", "b")]))
    ranked = spark.createDataFrame([("v", "a", 1)], "customer_id string, article_id string, rank int")
    recs = TS.route_cold_start(users(spark, "u", "v"), ranked, model, 3)
    assert {tuple(r) for r in recs.collect()} == {("v", "a", 1, TS.RANKED), ("u", "b", 1, TS.POPULAR)}


def test_serve_checks_requests_and_answers_in_order(spark, two):
    requests = spark.createDataFrame(
        [("u01", 3), ("ghost", 2), ("", 5), (None, 5), ("u02", 0), ("u02", 51), ("u03", None), ("u01", 1)],
        "customer_id string, top_n int",
    )
    answers, refused = two.serve(requests)
    answered = answers.collect()
    assert sorted((r["customer_id"], r["top_n"]) for r in answered) == [("ghost", 2), ("u01", 1), ("u01", 3), ("u03", 10)]
    rows = {r["customer_id"]: r for r in answered if r["top_n"] != 1}
    assert [len(r["recommendations"]) for r in answered if r["top_n"] == 1] == [1]
    assert rows["u01"]["source"] == TS.RANKED
    assert [i["score"] for i in rows["u01"]["recommendations"]] == [1.0, 0.6667, 0.3333]
    assert [i["score"] for i in rows["ghost"]["recommendations"]] == [1.0, 0.5]
    ordered = [r["article_id"] for r in two.recommend(users(spark, "u01"), 3).orderBy("rank").collect()]
    assert [i["article_id"] for i in rows["u01"]["recommendations"]] == ordered
    reasons = sorted(r["reason"] for r in refused.collect())
    assert reasons == ["no customer_id"] * 2 + ["top_n outside 1 to 50"] * 2


def test_every_request_is_answered(spark):
    recs = spark.createDataFrame([("a", "x", 2, TS.RANKED), ("a", "y", 1, TS.RANKED)], "customer_id string, article_id string, rank int, source string")
    asked = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "bought all", 4), (4, "a", 1)], "request_id int, customer_id string, top_n int")
    rows = {r["request_id"]: r for r in TS.batch_response(asked, recs).collect()}
    assert [[i["article_id"] for i in rows[n]["recommendations"]] for n in (1, 2, 3, 4)] == [["y", "x"], ["y"], [], ["y"]]
    assert [i["score"] for i in rows[1]["recommendations"]] == [1.0, 0.5]
    assert [rows[n]["source"] for n in (1, 3)] == [TS.RANKED, TS.POPULAR]
    alone = spark.createDataFrame([("a",)], "customer_id string")
    assert TS.split_requests(alone)[0].first()["top_n"] == TS.DEFAULT_TOP_N


def test_bundle_round_trip(spark, two, lists, tmp_path):
    path = str(tmp_path / "bundle")
    asked = users(spark, "u01", "ghost")
    two.save(path)
    assert B.missing_parts(spark, path) == []
    back = TS.TwoStageRecommender.load(spark, path)
    assert back.n_candidates == two.n_candidates
    assert lists(back.recommend(asked, 5)) == lists(two.recommend(asked, 5))
    assert B.read_json(spark, f"{B.current_path(spark, path)}/feature_schema")["feature_cols"] == two.ranker.feature_cols


class _BrokenOff(RuntimeError):
    pass


def lines_above(plan, mark):
    """The operators from the scan that holds ``mark`` up to its join."""
    lines = plan.splitlines()
    depth = lambda line: max(line.find("+-"), line.find(":-"))
    at = next(i for i, line in enumerate(lines) if mark in line)
    found, least = [lines[at]], depth(lines[at])
    for line in lines[at - 1 :: -1]:
        if depth(line) < least:
            found, least = [*found, line], depth(line)
        if "Join" in found[-1]:
            return found
    raise AssertionError("no join above the scan")


def test_customer_features_of_a_bundle_are_joined_without_an_exchange(spark, two, lists, tmp_path):
    path = str(tmp_path / "it's a bundle")
    two.save(path)
    name = SM._bucketed_name(f"{path}/versions/1/user_features")
    asked = users(spark, "u01", "u02", "u03")
    want = lists(two.rerank(asked, 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # As another session would find it: files and manifest, but no entry in the catalog.
        SM.forget_bucketed(spark, f"{path}/versions/1/user_features")
        assert not spark.catalog.tableExists(name)
        loaded = TS.TwoStageRecommender.load(spark, path)
        ranked = loaded.rerank(asked, 5)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        way = lines_above(plan, "Bucketed: true")
        assert not any("Exchange" in line for line in way), way
        assert lists(ranked) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_planted_taste_is_learned(spark, make_tx):
    """Six groups of customers, each with ten articles of its own: what is popular fits one customer in six."""
    rnd = random.Random(9)
    start, rows = dt.date(2020, 1, 1), []
    for u in range(72):
        mine = [f"{10 * (u % 6) + i:010d}" for i in range(10)]
        rnd.shuffle(mine)
        for d, article in enumerate(mine[:9]):
            rows.append(((start + dt.timedelta(days=d if d < 7 else 2 * d - 7)).isoformat(), f"u{u:02d}", article, 5.0, 1))
    params = dataclasses.replace(PARAMS, n_candidates=20, als=A.ALSParams(factors=8, iterations=8))
    trained = PL.train_models(make_tx(rows), params)
    told = {(r["model"], r["split"]): r for r in PL.compare_trained(trained, params).collect()}
    for split in ("val", "test"):
        base, als, both = (told[m, split] for m in ("popularity", "als_raw", "two_stage"))
        assert als["ndcg"] > 2 * base["ndcg"] and both["ndcg"] > 2 * base["ndcg"]
        assert both["recall"] >= 0.9 > 2 * base["recall"]


def test_a_save_that_stops_half_way_serves_the_old_bundle(spark, two, tmp_path, monkeypatch):
    path = str(tmp_path / "bundle")
    assert two.save(path) == 1
    monkeypatch.setattr(type(two.popularity), "save", lambda *_: (_ for _ in ()).throw(_BrokenOff()))
    with pytest.raises(_BrokenOff):
        dataclasses.replace(two, n_candidates=7).save(path)
    monkeypatch.undo()
    assert B.current_version(spark, path) == 1
    assert B.missing_parts(spark, path) == []
    assert TS.TwoStageRecommender.load(spark, path).n_candidates == two.n_candidates
    assert dataclasses.replace(two, n_candidates=8).save(path) == 3
    assert TS.TwoStageRecommender.load(spark, path).n_candidates == 8
    assert two.save(path) == 4
    assert B.drop_old_versions(spark, path) == [1, 2]
    assert TS.TwoStageRecommender.load(spark, path).n_candidates == two.n_candidates


def test_a_version_with_lost_rows_is_refused(spark, two, tmp_path):
    path = str(tmp_path / "bundle")
    two.save(path)
    seen = f"{B.current_path(spark, path)}/seen"
    spark.createDataFrame(two.seen.limit(1).collect(), two.seen.schema).write.mode("overwrite").parquet(seen)
    assert B.missing_parts(spark, path) == ["seen"]
    with pytest.raises(FileNotFoundError, match="incomplete"):
        TS.TwoStageRecommender.load(spark, path)


def test_incomplete_bundle_is_refused(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="incomplete"):
        TS.TwoStageRecommender.load(spark, str(tmp_path / "nothing"))


def test_features_are_needed_before_serving_and_saving(spark, two, tmp_path):
    bare = TS.TwoStageRecommender(two.als, two.ranker, two.popularity)
    with pytest.raises(RuntimeError, match="fit_features"):
        bare.recommend(users(spark, "u01"))
    with pytest.raises(RuntimeError, match="fit_features"):
        bare.save(str(tmp_path / "x"))


@pytest.fixture(scope="module")
def dimensions(spark, tx):
    articles = tx.select("article_id").distinct().select(
        "article_id",
        *[F.lit("x").alias(c) for c in ("product_type_name", "product_group_name", "colour_group_name", "department_name")],
    )
    return articles, tx.select("customer_id").distinct()


def test_retrain_exports_only_past_the_gate(spark, tx, dimensions, tmp_path):
    blocked = str(tmp_path / "blocked")
    with pytest.raises(PL.PromotionBlocked, match="below 1.1"):
        PL.retrain(tx, *dimensions, blocked, PARAMS, threshold=1.1)
    assert B.missing_parts(spark, blocked) == B.REQUIRED_PARTS
    out = str(tmp_path / "model")
    comparison = PL.retrain(tx, *dimensions, out, PARAMS, threshold=0.0)
    rows = {(r["model"], r["split"]): r for r in comparison.collect()}
    assert set(rows) == {(m, s) for m in ("popularity", "als_raw", "two_stage") for s in ("val", "test")}
    assert all(0.0 <= r["ndcg"] <= 1.0 for r in rows.values())
    assert {r["n_users"] for (m, s), r in rows.items() if s == "test"} == {40}
    assert B.missing_parts(spark, out) == []
    assert spark.read.json(f"{B.current_path(spark, out)}/eval_report").count() == 6
    meta = B.read_json(spark, f"{B.current_path(spark, out)}/ranker_meta")
    assert meta["n_rows"] == meta["n_positive"] + meta["n_negative"]
    assert meta["n_transactions"] == tx.count()
    assert len(meta["feature_importance"]) == 15


def test_retrain_stops_on_hard_data_errors(tx, dimensions, tmp_path):
    bad = tx.withColumn("price", F.when(F.col("customer_id") == "u01", -1.0).otherwise(F.col("price")))
    with pytest.raises(DataValidationError, match="non_positive_price"):
        PL.retrain(bad, *dimensions, str(tmp_path / "m"), PARAMS, threshold=0.0)


def test_a_broken_run_is_taken_up_after_its_finished_stages(spark, tx, dimensions, tmp_path, monkeypatch):
    out, fits = str(tmp_path / "model"), []
    fit = PL.ALSCandidates.fit.__func__
    monkeypatch.setattr(PL.ALSCandidates, "fit", classmethod(lambda cls, *a, **k: fits.append(1) or fit(cls, *a, **k)))
    with monkeypatch.context() as broken:
        broken.setattr(PL, "fit_lambdamart", lambda *_: (_ for _ in ()).throw(_BrokenOff()))
        with pytest.raises(_BrokenOff):
            PL.retrain(tx, *dimensions, out, PARAMS, threshold=0.0)
    assert B.current_version(spark, out) is None
    PL.retrain(tx, *dimensions, out, PARAMS, threshold=0.0)
    assert len(fits) == 1
    assert B.missing_parts(spark, out) == []
    # Other purchases or parameters are another run.
    assert PL.run_fingerprint(tx, PARAMS) == PL.run_fingerprint(tx.orderBy("price"), PARAMS)
    assert PL.run_fingerprint(tx, PARAMS) != PL.run_fingerprint(tx.limit(5), PARAMS)
    assert PL.run_fingerprint(tx, PARAMS) != PL.run_fingerprint(tx, dataclasses.replace(PARAMS, seed=1))
