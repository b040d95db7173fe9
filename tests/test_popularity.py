"""Popularity ranking and recommendations, including customers who bought most of the catalogue."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from basketlens.operators import popularity as P
from basketlens.operators import ranking as R
from basketlens.plans import numbering as N


@pytest.fixture(scope="module")
def train(make_tx):
    sold = {"pen": "ann ann ben cas", "ink": "ann dora dora", "map": "ben"}
    buys = [(who, what) for what, buyers in sold.items() for who in buyers.split()]
    return make_tx([("2020-01-01", u, a) for u, a in buys])


@pytest.fixture(scope="module")
def model(train):
    return P.PopularityModel.fit(train)


def users(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "customer_id string")


def test_ranking(model):
    rows = model.top_k(3).orderBy("pop_rank").collect()
    assert [(r["article_id"], r["purchase_count"]) for r in rows] == [("pen", 4), ("ink", 3), ("map", 1)]
    assert model.n_articles == 3
    assert model.top_k(100).count() == 3


def test_equal_counts_go_by_article_id(make_tx):
    m = P.PopularityModel.fit(make_tx([("2020-01-01", "u", a) for a in ("b", "c", "a")]))
    assert [r["article_id"] for r in m.top_k(2).orderBy("pop_rank").collect()] == ["a", "b"]


def test_recommend(spark, model, lists):
    asked = users(spark, "ann", "ben", "cas", "nobody")
    assert lists(model.recommend(asked, 10)) == {
        "ann": ["map"],
        "ben": ["ink"],
        "cas": ["ink", "map"],
        "nobody": ["pen", "ink", "map"],
    }
    assert lists(model.recommend(asked, 2, exclude_seen=False)) == {
        u: ["pen", "ink"] for u in ("ann", "ben", "cas", "nobody")
    }
    assert lists(model.recommend(users(spark, "nobody"), 2)) == {"nobody": ["pen", "ink"]}


def test_long_rankings_are_numbered_in_parallel(model, monkeypatch):
    monkeypatch.setattr(N, "ORDERED_LIMIT_ROWS", 0)
    rows = model.top_k(2).orderBy("pop_rank").collect()
    assert [tuple(r) for r in rows] == [("pen", 4, 1), ("ink", 3, 2)]


def test_repeated_and_missing_requests_count_once(spark, model, lists):
    asked = users(spark, "ann", "ann", None)
    assert lists(model.recommend(asked, 5)) == {"ann": ["map"]}


def test_errors(spark, make_tx, model):
    with pytest.raises(ValueError, match="empty"):
        P.PopularityModel.fit(make_tx([]))
    with pytest.raises(ValueError, match="article_id"):
        P.PopularityModel.fit(spark.createDataFrame([("u1",)], "customer_id string"))
    with pytest.raises(ValueError, match="k must"):
        model.recommend(users(spark, "ann"), 0)
    with pytest.raises(ValueError, match="k must"):
        model.top_k(0)


def test_without_customers_everybody_gets_the_global_list(spark, train, lists):
    m = P.PopularityModel.fit(train.select("article_id"))
    assert lists(m.recommend(users(spark, "ann"), 2)) == {"ann": ["pen", "ink"]}


def test_save_and_load(spark, model, lists, tmp_path):
    model.save(str(tmp_path / "pop"))
    back = P.PopularityModel.load(spark, str(tmp_path / "pop"))
    assert back.n_articles == 3
    assert lists(back.recommend(users(spark, "ann", "x"), 5)) == lists(model.recommend(users(spark, "ann", "x"), 5))


@pytest.mark.parametrize(("prefix_rows", "chunk"), [(10_000, 4096), (8, 7), (1, 4096)])
@pytest.mark.parametrize("k", [1, 3, 12])
def test_equals_brute_force(spark, make_tx, lists, monkeypatch, prefix_rows, chunk, k):
    """One customer makes a third of all purchases and owns nearly everything; another owns it all."""
    monkeypatch.setattr(P, "CHUNK", chunk)
    rnd = random.Random(3)
    items = [f"a{i:02d}" for i in range(40)]
    buys = [(f"u{rnd.randrange(15)}", items[min(39, int(rnd.expovariate(0.1)))]) for _ in range(300)]
    buys += [("hot", a) for a in items[:37] for _ in range(4)] + [("all", a) for a in items]
    model = P.PopularityModel.fit(make_tx([("2020-01-01", u, a) for u, a in buys]), prefix_rows=prefix_rows)
    counts = Counter(a for _, a in buys)
    ranking = sorted(counts, key=lambda a: (-counts[a], a))
    names = ["hot", "all", "nobody", *[f"u{i}" for i in range(15)]]
    want = {}
    for u in names:
        seen = {a for v, a in buys if v == u}
        unseen = [a for a in ranking if a not in seen][:k]
        if unseen:
            want[u] = unseen
    recs = model.recommend(users(spark, *names), k)
    assert lists(recs) == want
    ranks = {}
    for r in recs.collect():
        ranks.setdefault(r["customer_id"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks.values())


def test_long_lists_are_dealt_by_their_rows(spark, make_tx, lists, monkeypatch):
    """Few bytes move for a list, so merged tasks would hold, and sort again, the lists of too many customers."""
    model = P.PopularityModel.fit(make_tx([("2020-01-01", f"u{i}", f"a{(i + j) % 9}") for i in range(30) for j in range(i % 4 + 1)]))
    whole = lists(model.recommend(model.seen, 5))
    monkeypatch.setattr(P, "ROWS_PER_TASK", 15)
    dealt = model.recommend(model.seen, 5)
    assert lists(dealt) == whole and len(whole) == 30
    # 150 rows, ten tasks; what is joined to the lists moves to them.
    assert dealt.rdd.getNumPartitions() == 10
    truth = spark.createDataFrame([(f"u{i}", f"a{i % 9}") for i in range(30)], "customer_id string, article_id string")
    sampled = R.negative_sample(R.labelled_pairs(dealt.withColumnRenamed("rank", "als_rank"), truth), 2)
    assert sampled.rdd.getNumPartitions() == 10
