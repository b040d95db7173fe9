"""The solver of ALS in blocks: the library's factors, rows with many and few ratings; the search for the best products."""

from __future__ import annotations

import dataclasses

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from basketlens.operators import als as A
from basketlens.operators import als_solver as L


@pytest.fixture(scope="module")
def counts(spark):
    """Fifty customers of thirty articles, two of which nearly everybody bought."""
    rnd = np.random.default_rng(4)
    bought = {(int(u), int(i)) for u, i in zip(rnd.integers(0, 50, 300), rnd.integers(0, 30, 300))}
    bought |= {(u, i) for u in range(48) for i in (3, 4)} | {(0, i) for i in range(30)} | {(u, u % 30) for u in range(50)}
    rows = [(u, i, int(rnd.integers(1, 4))) for u, i in sorted(bought)]
    return spark.createDataFrame(rows, "customer_idx int, article_idx int, purchase_count long").cache()


@pytest.mark.parametrize(("rank", "blocks"), [(4, 1), (12, 3)])
def test_factors_are_those_of_the_library(counts, monkeypatch, rank, blocks):
    monkeypatch.setattr(L, "LEAST_RATINGS", counts.count() // blocks)
    given = L.RatingBlocks.of(counts, 50, 30)
    assert given.n_blocks == blocks
    own = given.fit(rank, 5, 0.05, 20.0, 9)
    library = ALS(
        rank=rank, maxIter=5, regParam=0.05, alpha=20.0, seed=9, implicitPrefs=True, numUserBlocks=10, numItemBlocks=10,
        userCol="customer_idx", itemCol="article_idx", ratingCol="purchase_count",
    ).fit(counts.withColumn("purchase_count", F.col("purchase_count").cast("float")))
    for mine, theirs in ((own.userFactors, library.userFactors), (own.itemFactors, library.itemFactors)):
        mine, theirs = ({r["id"]: r["features"] for r in t.collect()} for t in (mine, theirs))
        assert mine.keys() == theirs.keys()
        for i, features in theirs.items():
            assert mine[i] == pytest.approx(features, rel=1e-3, abs=1e-4)
    assert len(given._starts) == 1
    assert own.userFactors.exceptAll(given.fit(rank, 5, 0.05, 20.0, 9).userFactors).isEmpty()


def test_rows_are_solved_by_the_shorter_way(monkeypatch):
    """Rows of 0 to 40 ratings for 6 factors, those with many in steps, equal the equations written out."""
    rnd = np.random.default_rng(2)
    source, lengths = rnd.normal(size=(60, 6)), np.array([0, 1, 3, 6, 7, 40, 3, 40])
    begins = np.concatenate([[0], np.cumsum(lengths)])
    at, extra = rnd.integers(0, 60, begins[-1]), rnd.integers(0, 5, begins[-1]).astype(float)
    shared = np.array([0.0, 0.5, 1, 2, 3, 4])
    for step in (16_384, 8):
        monkeypatch.setattr(L, "_RATINGS_PER_STEP", step)
        out = L.solve_rows(source, begins, at, extra, shared, 0.1)
        assert not out[0].any()
        for i in range(1, len(lengths)):
            y, c = source[at[begins[i] : begins[i + 1]]], extra[begins[i] : begins[i + 1]]
            system = np.diag(shared + 0.1 * lengths[i]) + y.T @ (c[:, None] * y)
            assert out[i] == pytest.approx(np.linalg.solve(system, y.T @ (1 + c)))


@pytest.mark.parametrize("k", [1, 7, 40, 300])
def test_search_equals_sorting_all_products(monkeypatch, k):
    """Single precision alone would confuse products that differ by less; equal articles go by index."""
    rnd = np.random.default_rng(k)
    goods = rnd.normal(size=(230, 5)).astype(np.float32)
    goods[100:160] = goods[:60] * np.float32(1 + 2.0**-22)
    goods[160:200] = goods[:40]
    people = np.concatenate([rnd.normal(size=(30, 5)), np.zeros((1, 5))]).astype(np.float32)
    owned = [rnd.choice(230, n, replace=False) for n in rnd.integers(0, 20, 30)] + [np.arange(228)]
    pairs = np.repeat(np.arange(31), [len(o) for o in owned]), np.concatenate(owned)
    exact = (people.astype(np.float64)[:, None, :] * goods.astype(np.float64)).sum(axis=2).astype(np.float32)
    monkeypatch.setattr(A, "_PAIRS_PER_STEP", 100)
    for size, cuts in ((23, [230]), (64, [230]), (10, [90, 170, 230])):
        blocks, by_norm = [], np.argsort(-np.linalg.norm(goods, axis=1))
        for own in np.split(by_norm, cuts[:-1]):
            slices = A.norm_slices(own, goods[own], size)
            blocks.append((slices[0].norm, lambda slices=slices: slices))
        ids, best = A._search(people, pairs, blocks, k, None)
        for u in range(31):
            left = sorted(set(range(230)) - set(owned[u].tolist()), key=lambda g: (-exact[u, g], g))[:k]
            assert ids[u].tolist() == left + [-1] * (k - len(left))
            assert best[u, : len(left)].tolist() == exact[u, left].tolist()


def test_lists_are_named_by_the_tasks(spark, make_tx, lists, monkeypatch):
    """Ids come in blocks; candidates are not joined to the articles."""
    buys = [(f"c{i:02d}", f"g{(i * 7 + 3 * j) % 31:03d}") for i in range(20) for j in range(4)]
    m = A.ALSCandidates.fit(make_tx([("2021-03-01", u, a) for u, a in buys]), A.ALSParams(factors=3, iterations=1))
    whole = lists(m.recommend(m.users, 9), "als_rank")
    index = {r["article_id"]: r["article_idx"] for r in m.items.collect()}
    monkeypatch.setattr(A, "BLOCK_NAMES", 60)
    assert len(A._name_blocks(m.items)) > 3
    recs = dataclasses.replace(m, block_factors=30).recommend(m.users, 9)
    assert lists(recs, "als_rank") == whole
    numbered = m.users.join(m.model.userFactors.withColumnRenamed("id", "customer_idx"), "customer_idx")
    by_index = A.rank_candidates(numbered, m.model.itemFactors, m.counts, 9, 100).withColumnRenamed("article_idx", "article_id")
    assert {c: [index[a] for a in listed] for c, listed in whole.items()} == lists(by_index, "als_rank")
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert "article_id#" not in plan.split("MapInArrow", 1)[1].split("\n", 1)[1]
