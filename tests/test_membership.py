"""Bitmaps of the articles per customer, and the flags that candidates get from them."""

from __future__ import annotations

import pytest

from basketlens.operators import membership as MB

PAIRS = "customer_id string, article_id string"


@pytest.fixture(scope="module")
def bought(spark):
    rows = [("ann", "a1"), ("ann", "a3"), ("ann", "a3"), ("bea", "a2"), (None, "a1"), ("ann", None)]
    return spark.createDataFrame(rows, PAIRS)


@pytest.fixture(scope="module")
def wide(spark):
    """Numbers around the edges of bytes and of buckets."""
    edges = [1, 2, 8, 9, 32767, 32768, 32769, 65536, 65537, 100_000]
    return spark.createDataFrame([(f"w{n}", n) for n in edges], "article_id string, article_idx long")


def flags(df, *names):
    return sorted((r["customer_id"] or "", r["article_id"] or "", *[r[n] for n in names]) for r in df.collect())


def asked(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], PAIRS + ", als_rank int")


def test_pairs_and_stored_bitmaps_give_the_same_flags(spark, bought):
    rows = [("ann", "a1"), ("ann", "a2"), ("ann", "new"), ("bea", "a2"), ("cem", "a1"), (None, "a1"), ("ann", None)]
    want = sorted((c or "", a or "", int((c, a) in {("ann", "a1"), ("bea", "a2")})) for c, a in rows)
    for table in (bought, MB.ArticleSets.of(bought)):
        out = MB.flagged(asked(spark, rows), seen=table)
        assert out.columns == ["customer_id", "article_id", "als_rank", "seen"]
        assert flags(out, "seen") == want


def test_edges_of_bytes_and_buckets(spark, wide):
    articles = [r["article_id"] for r in wide.collect()]
    for own in (articles[::2], articles[1::2], articles):
        sets = MB.ArticleSets.of(spark.createDataFrame([("u", a) for a in own], PAIRS), wide)
        got = flags(MB.flagged(asked(spark, [("u", a) for a in articles]), seen=sets), "seen")
        assert got == sorted(("u", a, int(a in own)) for a in articles)
        assert sets.sizes().first()["n_articles"] == len(own)


def test_bitmaps_of_periods_merge(spark, wide):
    halves = [("u", "w1"), ("v", "w8"), ("u", "w32768")], [("u", "w2"), ("u", "w1"), ("v", "w100000")]
    older, younger = (MB.ArticleSets.of(spark.createDataFrame(h, PAIRS), wide) for h in halves)
    whole = MB.ArticleSets.of(spark.createDataFrame(halves[0] + halves[1], PAIRS), wide)
    merged = older.merged(younger)
    assert sorted(map(tuple, merged.rows.collect())) == sorted(map(tuple, whole.rows.collect()))
    assert {r["customer_id"]: r["n_articles"] for r in merged.sizes().collect()} == {"u": 3, "v": 2}


def test_two_tables_repeated_candidates_and_an_empty_table(spark, bought):
    rows = [("ann", "a1"), ("ann", "a1"), ("ann", "a9"), ("bea", "a3")]
    label = spark.createDataFrame([("ann", "a9"), ("bea", "a2")], PAIRS)
    out = MB.flagged(asked(spark, rows), label=label, seen=bought)
    want = [("ann", "a1", 0, 1), ("ann", "a1", 0, 1), ("ann", "a9", 1, 0), ("bea", "a3", 0, 0)]
    assert flags(out, "label", "seen") == want
    # The stored numbers do not know a9, which only the labels have.
    assert flags(MB.flagged(asked(spark, rows), label=label, seen=MB.ArticleSets.of(bought)), "label", "seen") == want
    assert {f[2] for f in flags(MB.flagged(asked(spark, rows), seen=bought.limit(0)), "seen")} == {0}


def test_one_exchange_beside_the_numbers(spark, bought):
    out = MB.flagged(asked(spark, [("ann", "a1")]), seen=MB.ArticleSets.of(bought))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_saved_and_loaded(spark, bought, tmp_path):
    MB.ArticleSets.of(bought).save(str(tmp_path))
    loaded = MB.ArticleSets.load(spark, str(tmp_path))
    assert flags(MB.flagged(asked(spark, [("ann", "a3"), ("ann", "a2")]), seen=loaded), "seen") == [("ann", "a2", 0), ("ann", "a3", 1)]


def test_bitmaps_take_no_more_than_their_pairs(spark):
    """A customer with articles far apart has a number for each, not 4 KB; the last bit of a number is the sign."""
    places = [1, 63, 64, 65, 128, 129, 70_000, 900_000]
    numbers = spark.createDataFrame([(f"w{n}", n) for n in places], "article_id string, article_idx long")
    own = [("u", f"w{n}") for n in places if n not in (63, 129)]
    sets = MB.ArticleSets.of(spark.createDataFrame(own * 2, PAIRS), numbers)
    assert dict(sets.rows.dtypes)["bitmap"] == "bigint"
    assert sets.rows.count() <= len(own)
    assert sets.merged(sets).sizes().first()["n_articles"] == len(own)
    got = flags(MB.flagged(asked(spark, [("u", f"w{n}") for n in places]), seen=sets), "seen")
    assert got == sorted(("u", f"w{n}", int(n not in (63, 129))) for n in places)
