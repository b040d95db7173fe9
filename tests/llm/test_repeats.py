"""Repeats by interval trees against a table of all strings of the least length."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import repeat_intervals as R
from basketlens.llm.queries import llm_queries

COLUMNS = "doc_id long, text string"


def brute(docs, length):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, what is left)}"""
    order = sorted({(i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), (t or "").encode()) for i, t in docs})
    seen, out = set(), {}
    for no_id, i, _, body in order:
        gone = np.zeros(len(body) + 1, bool)
        for at in range(len(body) - length + 1):
            piece = body[at : at + length]
            if piece in seen:
                gone[at : at + length] = True
            seen.add(piece)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        left = bytes(b for b, g in zip(body, gone) if not g)
        out[None if no_id else i, body] = (len(body), int(gone.sum()), runs, left)
    return out


def found(df):
    rows = df.collect()
    out = {(r["doc_id"], (r["text"] or "").encode()): (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}
    return out, len(rows)


def check(spark, docs, length, **how):
    df = spark.createDataFrame(docs, COLUMNS)
    out, n = found(R.remove_repeats(df, length, **how))
    assert n == len(docs)
    assert out == brute(docs, length)
    return out


def made_docs(seed, n, letters="ab cdé"):
    """Texts of shared passages between own ones, copies, near copies and periodic texts."""
    rng = np.random.default_rng(seed)

    def text(size):
        return "".join(rng.choice(list(letters), size))

    shared = [text(int(s)) for s in rng.integers(10, 90, 8)]
    docs = []
    for i in range(n):
        parts = [str(rng.choice(shared)) if rng.random() < 0.5 else text(int(rng.integers(0, 30))) for _ in range(5)]
        docs.append((i * 3, "".join(parts)))
    docs += [(1000 + i, docs[5 * i][1]) for i in range(5)]
    for i in range(12):
        near = list(docs[7][1])
        near[int(rng.integers(0, max(1, len(near))))] = "Z"
        docs.append((2000 + i, "".join(near)))
    docs += [(3000, "x" * 200), (3001, "xy" * 120), (3002, "x" * 150 + "q" + "x" * 60)]
    rng.shuffle(docs)
    return [(int(i), str(t)) for i, t in docs]


@pytest.mark.parametrize("length, how", [(12, {}), (40, {}), (12, {"bucket_contexts": 1}), (40, {"bucket_contexts": 3})])
def test_removed_bytes_equal_brute_force(spark, length, how):
    out = check(spark, made_docs(length, 60), length, **how)
    assert sum(v[1] for v in out.values()) > 1000


def test_a_line_in_many_documents(spark):
    rng = np.random.default_rng(9)
    line = "this line stands in every one of the documents, word for word"
    docs = [(i, f"{rng.integers(0, 10**12)} {line} {rng.integers(0, 10**12)}") for i in range(300)]
    for how in ({}, {"bucket_contexts": 20}):
        out = check(spark, docs, 40, **how)
        assert sum(v[1] > 0 for v in out.values()) == 299


def test_short_stretches_and_sorts_change_nothing(spark, monkeypatch):
    docs = made_docs(3, 30)
    octets = [t.encode() for _, t in docs]
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in octets])))
    joined = np.frombuffer(b"".join(octets), np.uint8)

    def strings(length):
        text, start, count, gram = R.contexts_of(joined, offsets, length)
        return {(int(a) + i, int(g)) for a, n, g in zip(start, count, gram) for i in range(n)}

    for length in (12, 40, 100):
        whole = strings(length)
        assert len(whole) == sum(max(0, len(b) - length + 1) for b in octets)
        monkeypatch.setattr(R, "_STRETCH", 57)
        assert strings(length) == whole
        monkeypatch.undo()


def test_contexts_are_made_of_a_stretch_of_rows_at_a_time(monkeypatch):
    docs = [(1, ""), (2, "x" * 500), *made_docs(6, 40), (9, "")]
    columns = [pa.array([i for i, _ in docs]), pa.array([t.encode() for _, t in docs])]
    batch = pa.RecordBatch.from_arrays(columns, ["_doc", "_bytes"])

    def contexts(rows, whole):
        return pa.Table.from_batches(R._all_contexts(40, whole)(iter(rows)))

    wholly = [contexts([batch], whole) for whole in (False, True)]
    monkeypatch.setattr(R, "_STRETCH", 200)
    parts = [*R._parts(batch)]
    assert len(parts) > 5 and sum(map(len, parts)) == len(docs)
    # A part ends before its bytes and the last row's are more than a stretch.
    assert all(sum(len(b.as_buffer()) for b in p.column(1)[:-1]) <= 200 for p in parts)
    again = [contexts([batch.slice(0, 7), batch.slice(7, 0), batch.slice(7)], whole) for whole in (False, True)]
    strings = [{(d, (p >> 16) + i, g) for g, _, d, p in zip(*(c.to_pylist() for c in t.columns)) for i in range(p & 0xFFFF)} for t in (wholly[1], again[1])]
    assert strings[0] == strings[1] and len(again[1]) == len(again[0])
    assert len(again[1].column(0).chunks) > 5


def test_small_intermediates_have_one_file(spark, new_files):
    check(spark, made_docs(12, 60), 12, bucket_contexts=3)
    files = new_files()
    assert len(files) >= 4 and set(files.values()) == {1}


def test_suffix_array_and_nodes_equal_brute_force():
    rng = np.random.default_rng(4)
    bodies = [bytes(rng.integers(97, 99, n, dtype=np.uint8)) for n in (30, 25, 40, 9, 40)] + [b"\0a\0a\0a\0a\0a\0a"]
    counts = np.array([len(b) - 7 for b in bodies])
    buckets = np.array([0, 0, 0, 1, 1, 1])
    s = R.Suffixes(bodies, counts, buckets)
    rows = [(buckets[c], bodies[c][i:]) for c, i in zip(s.context, s.inside)]
    assert rows == sorted(rows) and len(rows) == counts.sum()

    def prefix(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert s.common.tolist() == [prefix(a[1], b[1]) if a[0] == b[0] else 0 for a, b in zip(rows, rows[1:])]
    order = np.empty(len(rows), np.int64)
    order[np.lexsort((s.inside, s.context))] = np.arange(len(rows))
    nodes = list(R.repeat_nodes(s, order, np.ones(len(rows), np.int64), 6))
    told = {}
    for low, high, length, n, listed, first in nodes:
        inside = {i for a, b, *_, more, _ in nodes if low <= a and b <= high for i in more}
        places = {(int(s.context[i]), int(s.inside[i])) for i in inside}
        assert n == high - low + 1 == len(places) and order[first] == min(order[i] for i in inside)
        told[rows[low][0], rows[low][1][:length]] = places
    expected = {}
    for b in (0, 1):
        for c in np.flatnonzero(buckets == b):
            for i in range(counts[c]):
                for end in range(i + 6, len(bodies[c]) + 1):
                    expected.setdefault((b, bodies[c][i:end]), set()).add((int(c), i))
    # Maximal: two occurrences or more, not all of which go on alike to the left or to the right.
    def maximal(text, places):
        before = {bodies[c][i - 1 : i] if i else (c,) for c, i in places}
        after = {bodies[c][i + len(text) : i + len(text) + 1] or (c,) for c, i in places}
        return len(places) > 1 and len(before) > 1 and len(after) > 1

    assert told == {key: places for key, places in expected.items() if maximal(key[1], places)}


def test_odd_documents(spark):
    long = "All work and no play makes Jack a dull boy, number {}.\n"
    docs = [
        (1, None), (2, ""), (3, "short"), (3, "short"), (4, "déjà " * 40), (4, "déjà " * 40), (4, "déjà " * 30 + "!"),
        (None, "déjà " * 40), (None, None), (None, "own words only, without any id, but long enough to have strings of its own"),
        (None, "own words only, without any id, but long enough to have strings of its own"),
        (6, "".join(long.format(i % 60) for i in range(400))), (5, "".join(long.format(i % 61) for i in range(300))),
    ]
    check(spark, docs, 40)
    check(spark, docs, 40, bucket_contexts=2)
    clashing = spark.createDataFrame(docs, COLUMNS).withColumns({c: F.lit(7) for c in ("n_bytes", "_doc", "_row", "gram", "kept", "start")})
    out = R.remove_repeats(clashing, 40)
    assert found(out)[0] == brute(docs, 40)
    assert out.columns == ["doc_id", "text", "_doc", "_row", "gram", "start", "kept", "n_bytes", "n_removed", "n_spans"]
    assert R.remove_repeats(clashing.limit(0)).count() == 0
    assert R.repeat_groups(clashing.limit(0)).count() == 0


def test_groups_list_every_occurrence(spark):
    line = "a passage of some length that stands in three documents"
    docs = [(i, f"{i * 7919} {line}{' and more' if i < 3 else ''} {i * 104729}") for i in (1, 2, 3)] + [(4, "nothing shared")]
    rows = R.repeat_groups(spark.createDataFrame(docs, COLUMNS), 40).collect()
    assert {r["document"] for r in rows} == {1, 2, 3}
    assert all(r["n"] == 3 or r["n"] == 2 for r in rows) and {r["document"] for r in rows if r["first"]} == {1}
    assert any(r["length"] > 50 for r in rows)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    expected = {i: (n, gone, runs, hashlib.sha256(left).hexdigest()) for (i, _), (n, gone, runs, left) in brute(docs, 100).items()}
    out = {r[0]: tuple(r[1:]) for r in llm_queries()["op11_repeat_intervals"](spark, "/root/testdata/sf0.001").collect()}
    assert out == expected and sum(v[1] for v in out.values()) > 0
