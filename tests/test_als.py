"""ALS: id maps, confidence matrix, candidate lists from one block of articles and from several, save and load, grid."""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
import pytest

from basketlens.operators import als as A
from basketlens.operators import features as FE
from basketlens.operators import split as SP

# Three shoppers at a grocer's: Ada lacks tea, Bob lacks milk and tea, Cid lacks bread.
BUYS = [
    *[("ada", a) for a in ("bread", "milk", "salt")],
    *[("bob", a) for a in ("bread", "salt")],
    *[("cid", a) for a in ("milk", "salt", "tea")],
]
SMALL = A.ALSParams(factors=4, iterations=2, regularization=0.1)


@pytest.fixture(scope="module")
def train(make_tx):
    return make_tx([("2020-01-01", u, a) for u, a in BUYS])


@pytest.fixture(scope="module")
def model(train):
    return A.ALSCandidates.fit(train, SMALL)


def users(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "customer_id string")


def test_confidence_matrix(train):
    m = A.user_item_confidence(train.unionByName(train.filter("customer_id = 'ada'")), alpha=40.0)
    rows = {(r["customer_idx"], r["article_idx"]): r["confidence"] for r in m.collect()}
    assert len(rows) == 8
    assert rows[0, 0] == 81.0
    assert rows[2, 3] == 41.0
    assert {r["confidence"] for r in A.user_item_confidence(train, alpha=0.0).collect()} == {1.0}


def test_id_index_is_sorted(train):
    rows = {r["article_id"]: r["i"] for r in A.id_index(train, "article_id", "i").collect()}
    assert rows == {"bread": 0, "milk": 1, "salt": 2, "tea": 3}


def test_sizes(model):
    assert (model.n_users, model.n_items) == (3, 4)


@pytest.mark.parametrize("block_factors", [A.BLOCK_FACTORS, 8])
def test_recommend(spark, model, lists, block_factors):
    m = dataclasses.replace(model, block_factors=block_factors)
    asked = users(spark, "ada", "bob", "cid", "bob", "stranger")
    unseen = lists(m.recommend(asked, 10), "als_rank")
    assert {u: sorted(v) for u, v in unseen.items()} == {"ada": ["tea"], "bob": ["milk", "tea"], "cid": ["bread"]}
    everything = lists(m.recommend(asked, 10, exclude_seen=False), "als_rank")
    assert all(sorted(v) == ["bread", "milk", "salt", "tea"] for v in everything.values())
    assert all(len(v) == 2 for v in lists(m.recommend(asked, 2, exclude_seen=False), "als_rank").values())
    rows = m.recommend(users(spark, "bob"), 10).orderBy("als_rank").collect()
    assert [(r["als_rank"], r["list_size"]) for r in rows] == [(0, 2), (1, 2)]


@pytest.mark.parametrize("exclude_seen", [True, False])
def test_any_number_of_blocks_gives_the_same_lists(spark, make_tx, lists, exclude_seen):
    """Customers and articles with the same purchases have the same factors, so scores tie; one customer bought
    nearly everything."""
    buys = [(f"c{i:02d}", f"g{(i // 2 + 5 * j) % 40 * 2 + twin:03d}") for i in range(24) for j in range(4) for twin in (0, 1)]
    buys += [("hoarder", f"g{i:03d}") for i in range(50)]
    m = A.ALSCandidates.fit(make_tx([("2021-03-01", u, a) for u, a in buys]), A.ALSParams(factors=5, iterations=3))
    whole = lists(m.recommend(m.users, 12, exclude_seen), "als_rank")
    for items in (9, 30):
        blocks = dataclasses.replace(m, block_factors=5 * items)
        assert lists(blocks.recommend(m.users, 12, exclude_seen), "als_rank") == whole
    if exclude_seen:
        assert len(whole["hoarder"]) == m.n_items - 50
        assert all(not {a for v, a in buys if v == u} & set(listed) for u, listed in whole.items())


def test_blocks_equal_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    people, goods = rnd.integers(-2, 3, (9, 3)).astype(float), rnd.integers(-2, 3, (31, 3)).astype(float)
    owned = {(int(c), int(g)) for c, g in zip(rnd.integers(0, 9, 60), rnd.integers(0, 31, 60))} | {(0, g) for g in range(31)}
    customers = spark.createDataFrame(
        [(f"p{i}", i, f.tolist()) for i, f in enumerate(people)], "customer_id string, customer_idx int, features array<float>"
    )
    items = spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(goods)], "id int, features array<float>")
    bought = spark.createDataFrame(sorted(owned), "customer_idx int, article_idx int")
    want = []
    for c in range(9):
        left = [g for g in range(31) if (c, g) not in owned]
        left.sort(key=lambda g: (-people[c] @ goods[g], g))
        want += [(f"p{c}", g, n, len(left[:6])) for n, g in enumerate(left[:6])]
    for block, size in ((31, 4096), (31, 5), (30, 4096), (4, 3)):
        monkeypatch.setattr(A, "SLICE_ITEMS", size)
        got = A.rank_candidates(customers, items, bought, 6, block).drop("model_score").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_slices_out_of_reach_are_skipped(spark):
    """A few articles with large factors, and many that cannot beat them."""
    rnd = np.random.default_rng(3)
    goods = np.abs(rnd.normal(size=(600, 4))) * np.where(np.arange(600) % 100 == 0, 10.0, 0.1)[:, None]
    people = np.abs(rnd.normal(size=(40, 4)))
    customers = spark.createDataFrame(
        [(f"p{i}", i, f.tolist()) for i, f in enumerate(people)], "customer_id string, customer_idx int, features array<float>"
    )
    items = spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(goods)], "id int, features array<float>")
    lists = {}
    for block in (600, 20):
        counts = A.SearchCounts.of(spark)
        rows = A.rank_candidates(customers, items, None, 5, block, counts).collect()
        lists[block] = sorted((r["customer_id"], r["als_rank"], r["article_idx"]) for r in rows)
        assert counts.scored.value > 0
    assert lists[600] == lists[20]
    assert {i for *_, i in lists[20]} <= set(range(0, 600, 100))
    assert counts.scored.value == 40


def test_blocks_are_fetched_only_while_needed():
    """Once everybody's list is out of reach, later blocks are not read."""
    batch = pd.DataFrame({"customer_id": ["u"], "features": [[1.0, 0.0]], "bought": [None]})
    near, far = np.array([[9.0, 0.0], [8.0, 0.0]]), np.array([[0.5, 0.0]])

    def unread():
        raise AssertionError("this block cannot matter")

    blocks = [(9.0, lambda: A.norm_slices(np.array([7, 3]), near, 1)), (0.5, unread)]
    assert A.rank_customers(batch, blocks, 2)["article_idx"].tolist() == [7, 3]
    with pytest.raises(AssertionError):
        A.rank_customers(batch, blocks, 3)
    assert A.rank_customers(batch, [blocks[0], (0.5, lambda: A.norm_slices(np.array([5]), far, 1))], 3)["article_idx"].tolist() == [7, 3, 5]


def test_ties_are_cut_by_article():
    batch = pd.DataFrame({"customer_id": ["u", "v"], "features": [[1.0], [0.0]], "bought": [np.array([12]), None]})
    items = np.array([[1.0], [2.0], [9.0], [1.0], [1.0]])
    for size in (1, 2, 5):
        blocks = [(9.0, lambda: A.norm_slices(np.arange(10, 15), items, size))]  # noqa: B023
        out = A.rank_customers(batch, blocks, 3)
        assert out["article_idx"].tolist() == [11, 10, 13, 10, 11, 12]
        assert out["als_rank"].tolist() == [0, 1, 2] * 2
        assert A.rank_customers(batch, blocks, 50)["list_size"].tolist() == [4] * 4 + [5] * 5


def test_same_seed_same_factors(train):
    first, again = (A.ALSCandidates.fit(train, SMALL).model.userFactors.orderBy("id").collect() for _ in range(2))
    for a, b in zip(first, again):
        assert a["features"] == pytest.approx(b["features"], abs=1e-6)


def test_fit_from_stats_equals_fit_from_rows(spark, train, model, lists):
    other = A.ALSCandidates.fit(train, SMALL, stats=FE.interaction_stats(train))
    assert lists(other.recommend(other.users), "als_rank") == lists(model.recommend(model.users), "als_rank")


def test_errors(spark, make_tx, model):
    with pytest.raises(ValueError, match="empty"):
        A.ALSCandidates.fit(make_tx([]))
    with pytest.raises(ValueError, match="customer_id"):
        A.ALSCandidates.fit(spark.createDataFrame([("a1",)], "article_id string"))
    with pytest.raises(ValueError, match="k must"):
        model.recommend(model.users, 0)
    with pytest.raises(KeyError, match="no ALS factor"):
        model.require_known(users(spark, "ada", "stranger"))
    model.require_known(users(spark, "ada"))
    with pytest.raises(ValueError, match="factors"):
        A.ALSParams(factors=0)


def test_save_and_load(spark, model, lists, tmp_path):
    path = str(tmp_path / "deep" / "als")
    model.save(path)
    back = A.ALSCandidates.load(spark, path)
    assert back.params == SMALL
    assert (back.n_users, back.n_items) == (3, 4)
    assert lists(back.recommend(back.users), "als_rank") == lists(model.recommend(model.users), "als_rank")


def test_grid(make_tx):
    """Nine customers buy one of six articles a day; on the last day each buys one that is new to them."""
    steps = [0, 1, 3, 4, 5]
    days = [(f"2021-05-{3 + d:02d}", f"k{c}", f"w{(c + s) % 6}") for c in range(9) for d, s in enumerate(steps[:-1])]
    days += [("2021-05-20", f"k{c}", f"w{(c + steps[-1]) % 6}") for c in range(9)] + [("2021-05-25", "k0", "w0")]
    split = SP.make_temporal_split(make_tx(days), "2021-05-15", "2021-05-24")
    grid = [A.ALSParams(factors=2, iterations=1), A.ALSParams(factors=3, iterations=1, alpha=10.0)]
    rows = A.als_grid(split.train, SP.ground_truth(split, "val"), grid, k=2).collect()
    # Everybody has two unseen articles, and both are listed.
    assert [(r["config"], r["n_users"], r["recall"], r["hit_rate"]) for r in rows] == [(0, 9, 1.0, 1.0), (1, 9, 1.0, 1.0)]
    with pytest.raises(ValueError, match="grid is empty"):
        A.als_grid(split.train, SP.ground_truth(split, "val"), [])


def test_halving_finds_the_best_of_the_grid(make_tx):
    """Customers buy within their own half of the articles: one factor cannot tell the halves apart, four can."""
    days, last = [], []
    for c in range(24):
        own = [f"{'pq'[c % 2]}{i}" for i in range(8)]
        bought = [own[(c + s) % 8] for s in (0, 1, 2, 4, 5)]
        days += [(f"2021-05-{3 + d:02d}", f"k{c}", a) for d, a in enumerate(bought)]
        last.append(("2021-05-20", f"k{c}", own[(c + 3) % 8]))
    split = SP.make_temporal_split(make_tx(days + last + [("2021-05-25", "k0", "p0")]), "2021-05-15", "2021-05-24")
    truth = SP.ground_truth(split, "val")
    grid = [A.ALSParams(factors=f, iterations=8, alpha=a) for f in (1, 4) for a in (10.0, 40.0)] + [A.ALSParams(2, 8)]
    full = A.als_grid(split.train, truth, grid, k=3, jobs=1).collect()
    assert full == A.als_grid(split.train, truth, grid, k=3, jobs=3).collect()
    halved = A.als_halving(split.train, truth, grid, k=3).collect()
    assert halved[0]["config"] == full[0]["config"] and halved[0]["recall"] == full[0]["recall"]
    assert sorted(r["config"] for r in halved) == [0, 1, 2, 3, 4]
    assert [(r["round"], r["fitted_iterations"], r["iterations"]) for r in halved] == [(3, 8, 8), (2, 4, 8), (1, 2, 8), (0, 1, 8), (0, 1, 8)]
    with pytest.raises(ValueError, match="grid is empty"):
        A.als_halving(split.train, truth, [])
    with pytest.raises(ValueError, match="every second"):
        A.als_halving(split.train, truth, grid, keep=1)


def test_slices_that_only_tie_with_later_articles_are_skipped(spark):
    """Few different factors, each of many articles: norms tell nothing, boxes and first articles do."""
    n = 2000
    goods = np.array([[i % 4, i % 7 - 3, i % 2] for i in range(n)], np.float32)
    people = np.array([[c % 3, c % 5 - 2, 1.0] for c in range(15)])
    batch = pd.DataFrame({"customer_id": [f"p{c}" for c in range(15)], "features": list(people), "bought": [None] * 15})
    for size in (16, 17, n):
        counts = A.SearchCounts.of(spark)
        slices = A.norm_slices(np.arange(n), goods, size)
        assert sorted(i for s in slices for i in s.ids) == list(range(n)) and len(slices) == -(-n // size)
        out = A.rank_customers(batch, [(slices[0].norm, lambda: slices)], 6, counts)  # noqa: B023
        got = out.groupby("customer_id")["article_idx"].apply(list).to_dict()
        assert got == {f"p{c}": sorted(range(n), key=lambda i: (-people[c] @ goods[i], i))[:6] for c in range(15)}  # noqa: B023
        if size < n:
            assert counts.scored.value < 0.3 * 15 * len(slices)


def test_the_driver_builds_no_rows_of_factors(spark, monkeypatch):
    """Blocks come to the driver as bytes of slices, not as one object per article or number."""
    goods = np.random.default_rng(5).normal(size=(50, 4)).astype(np.float32)
    items = spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(goods)], "id int, features array<float>")
    monkeypatch.setattr(type(items), "toPandas", lambda _: pytest.fail("all rows of a block as objects"))
    monkeypatch.setattr(A, "SLICE_ITEMS", 6)
    blocks, bounds = A._item_blocks(items, 20)
    slices = [s for b in blocks for s in b.value]
    assert bounds == sorted(bounds, reverse=True) and len(blocks) == 3
    assert max(len(s.ids) for s in slices) <= 6
    assert np.array_equal(np.concatenate([s.factors for s in slices])[np.argsort(np.concatenate([s.ids for s in slices]))], goods)


def test_shuffles_of_earlier_iterations_do_not_stay(spark, train, monkeypatch):
    import pathlib
    import time

    from basketlens.plans import workspace

    monkeypatch.setattr(workspace, "RELEASE_SECONDS", 0.3)
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    kept = lambda: {f.name for d in dirs for f in pathlib.Path(d).glob("*/shuffle_*.data")}
    before = kept()
    A.ALSCandidates.fit(train, A.ALSParams(factors=2, iterations=24))
    stop = time.time() + 10
    while len(kept() - before) >= 100 and time.time() < stop:
        time.sleep(0.2)
    # 24 iterations write two shuffles of ten blocks each.
    assert len(kept() - before) < 100
