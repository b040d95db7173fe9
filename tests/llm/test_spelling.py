"""Spelling variants by k-d trees against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import spelling_kdtree as K
from basketlens.llm.queries import llm_queries
from basketlens.plans.workspace import written

SF = "/root/testdata/sf0.001"


def brute_words(docs):
    counts = Counter()
    for mark, text in docs:
        for found in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found)
            h = zlib.crc32(f"{mark}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    out, forms = {}, {}
    shelves = {}
    for w in words:
        shelves.setdefault(len(w), []).append(w)
    for w, n in words.items():
        near = [x for k in (-1, 0, 1) for x in shelves.get(len(w) + k, []) if x != w and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        forms[w] = form
        out[w] = [form, None, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def told(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def made_words():
    """Many near words: few letters, two lengths more than the least, and chains of forms."""
    rng = np.random.default_rng(5)
    words = {}
    for length in (7, 8, 9, 12):
        for letters in rng.integers(0, 4, (250, length)):
            words["".join("aeéÿ"[i] for i in letters)] = int(rng.choice([2, 3, 25, 300, 4000]))
    words |= {"chained": 2, "chainedd": 30, "chaineddd": 400, "chaine": 2, "chainedx": 30}
    return words


@pytest.mark.parametrize("cell_words, max_cell_words", [(10_000, 100_000), (40, 100_000), (40, 5), (10_000, 5)])
def test_variants_equal_brute_force(spark, cell_words, max_cell_words):
    words = made_words()
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    out = K.group_variants(df, cell_words=cell_words, max_cell_words=max_cell_words, sample_words=500)
    assert told(out) == brute(words)


def test_words_of_one_letter_multiset(spark):
    """No tree can cut them, and none of them are near each other."""
    rng = np.random.default_rng(6)
    words = {"".join(rng.permutation(list("abcdefgh"))): 2 + i for i in range(300)}
    words["abcdefgx"], words["abcdefghi"] = 9000, 9001
    words["abcdefgh"] = 5
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert told(K.group_variants(df, cell_words=20, max_cell_words=50)) == brute(words)
    assert told(K.group_variants(df, cell_words=20)) == brute(words)


def test_reach_holds_all_neighbours_and_prunes():
    rng = np.random.default_rng(7)
    vectors = K.letter_counts(rng.integers(97, 117, (3000, 9)).astype(np.uint8))
    tree, n = K.build_tree(vectors, 64)
    met = {(int(q), int(s)) for leaf, rows in K.within_reach(tree, vectors, down=True) for q in rows for s in leaf.rows}
    apart = np.abs(vectors[:, None].astype(np.int8) - vectors[None].astype(np.int8)).sum(axis=2)
    assert {(int(a), int(b)) for a, b in zip(*np.nonzero(apart <= 2))} <= met
    assert n > 30 and len(met) < 0.5 * len(vectors) ** 2


def test_word_counts_of_odd_documents(spark):
    long = "Überlange" * 50_000
    docs = [
        (1, "Straßen straßen STRASSEN, sixsix sevenen sevenen"), (1, "Straßen straßen STRASSEN, sixsix sevenen sevenen"),
        (2, None), (3, ""), (4, long), (5, long), (6, "naïveté-naïveté Ωmegamegam ÀÉÎÕÜñç ÀÉÎÕÜñç Ābcdefgh Ābcdefgh"),
    ]
    rows = [(i, t, 9, "x") for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, word string")
    found = {r["word"]: r["n"] for r in K.word_counts(df, damage=True).collect()}
    assert found == brute_words(docs)
    whole = {r["word"]: r["n"] for r in K.word_counts(df).collect()}
    assert whole["straßen"] == 4 and whole["sevenen"] == 4 and "sixsix" not in whole and whole["bcdefgh"] == 2
    assert K.group_variants(K.word_counts(df.limit(0))).count() == 0
    nulls = spark.createDataFrame([(None, "wordword wordword")], "doc_id long, text string")
    assert K.word_counts(nulls, damage=True).count() == 1
    # One word of 450,000 letters; U+00DC is not lower-cased.
    assert whole[long] == 2


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = written(llm_queries()["op13_spelling_kdtree"](spark, SF), "op13")
    assert told(out) == brute(brute_words(docs))
    assert out.where(F.col("form").isNotNull()).count() > 0
