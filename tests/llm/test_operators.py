"""The training-data operators against brute force, and their stated results for odd input."""

from __future__ import annotations

import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm import (
    decontaminate,
    language_id,
    line_chunks,
    packing,
    pii_surrogates,
    pivot_permutation,
    simhash_pivots,
    url_vocabulary,
    virtual_slots,
    warc_zstd,
)
from basketlens.llm.common import connected_components
from basketlens.llm.oracle import llm_oracles
from basketlens.llm.queries import URL_RULES, llm_queries
from basketlens.plans.workspace import scratch_path
from compare import connect, difference

SF = "/root/testdata/sf0.001"
KEY = b"0123456789abcdef"
LONG = "word " * 30_000
# Null, empty and repeated rows, ties, a very long text, and columns named like what operators add.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", 7),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", 7),
    (2, None, None, 8),
    (3, "", "en", 9),
    (4, " \t\n", None, None),
    (None, "a row without id", "en", 1),
    (None, None, None, None),
    (5, LONG, "de", 2),
    (6, "№ 42 — 漢字 été\nline two\nline three", "fr", 3),
    (7, "No.", None, 3),
]
COLUMNS = "doc_id long, text string, lang string, n_removed long"


@pytest.fixture(scope="module")
def odd(spark):
    clashing = "score fp shard pos hash n _id _mark _row _lines _chunks _wanted _gone _again _kept component_id"
    return spark.createDataFrame(ODD, COLUMNS).withColumns({c: F.lit(i) for i, c in enumerate(clashing.split())})


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def by_id(df, column="doc_id"):
    return {r[column]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(spark, name):
    assert difference(llm_queries()[name](spark, SF), connect(SF), llm_oracles()[name]) is None


# ---- 1 ----------------------------------------------------------------------------------------------------------


def test_surrogates_keep_kind_form_and_identity(spark):
    a = "Mail Bob.Roe@Mail.example.com or bob.roe@mail.example.com, +1 (988) 555-2485, 4041894974608795, 10.1.2.3."
    b = "Mrs. Anna Keller met Mr. Paul Roth. Keller left. password=b7db7aa4a5fcc78305 988-555-2485 4041894974608796"
    docs = spark.createDataFrame([(1, a, 1), (2, b, 2), (3, "Nothing here, 12 apples.", 3)], "doc_id long, text string, kinds int")
    out = by_id(pii_surrogates.replace_entities(docs, KEY))
    first, second = out[1]["text"], out[2]["text"]
    assert out[3]["text"] == "Nothing here, 12 apples." and out[3]["n_entities"] == 0
    for private in ("Roe", "roe@", "2485", "4041894974608795", "10.1.2.3", "Keller", "Roth", "b7db7aa4a5fcc78305"):
        assert private not in first + second
    mails = re.findall(r"\S+@\S+?\.com", first)
    assert mails[0] != mails[1] and mails[0].lower() == mails[1].lower()
    phone = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", first)
    assert "-".join(phone.groups()) in second
    card = re.search(r"\b4\d{15}\b", first)[0]
    assert pii_surrogates._luhn(card) == 0 and "4041894974608796" in second
    assert re.search(r" 10\.\d+\.\d+\.\d+\.$", first)
    given, family = re.match(r"Mrs\. (\w+) (\w+) met", second).groups()
    assert given in pii_surrogates.GIVEN["latin"]["f"] and f" {family} left" in second


def test_colliding_surrogates_are_drawn_again(spark):
    def narrow(key, kind, canon, attempt):  # 5 entities, draws from "s0" to "s5" and the real "b"
        return "b" if attempt == 0 and canon == "a" else f"s{(ord(canon) * (attempt + 1) + attempt) % 6}"

    rows = spark.createDataFrame([("secret", c) for c in "abcde"], "kind string, canon string")
    out = pii_surrogates.assign_surrogates(rows, KEY, narrow).collect()
    assert len(out) == 5 and len({r["new"] for r in out}) == 5 and not {r["new"] for r in out} & set("abcde")


def test_few_entities_are_settled_in_few_files(spark, new_files):
    texts = [f"Mail me{i}@host{i % 7}.co, Mrs. {n} Keller, card 4041894974608795" for i, n in enumerate(["Anna", "Eva", "Olga"] * 30)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    out = by_id(pii_surrogates.replace_entities(docs, KEY))
    assert all(out[i]["n_entities"] == 4 and "Keller" not in out[i]["text"] for i in range(90))
    assert len({re.search(r"\S+@\S+", r["text"])[0] for r in out.values()}) == 90
    files = new_files()
    documents = files.pop("entity-rows")
    assert documents <= 8 and len(files) >= 4 and set(files.values()) == {1}


def test_mentions_equal_a_search_for_all_names():
    rng = np.random.default_rng(2)
    people = {n: "family-latin" for n in ("Ann", "Ann-Lee", "Lee", "O'Neil", "Neil", "Annika", "Bo")}
    pieces = [*people, "ann", "Mc", "x", "-", "-", "'", " ", " ", ". ", "_"]
    for _ in range(300):
        text = "".join(rng.choice(pieces, 25))
        taken = pii_surrogates.Entity("secret", "", 10, 25)
        out = [taken]
        pii_surrogates._mentions(text, out, people)
        names = re.compile(r"(?<!\w)(?:" + "|".join(sorted(people, key=len, reverse=True)) + r")(?!\w)")
        want = [m.span() for m in names.finditer(text) if m.end() <= 10 or m.start() >= 25]
        assert [(e.start, e.end) for e in out[1:]] == want


def test_a_very_long_text_is_searched_in_one_go():
    names = [f"{a.capitalize()}{b}" for a in ("bar", "kor", "lin", "mos") for b in ("a" * n + c for n in range(1, 60) for c in "bdfghk")]
    text = " ".join(f"Mr. {n} wrote to {n.lower()}@mail.org and {n} left on {i} May." for i, n in enumerate(names * 100))
    assert len(text) > 9_000_000
    started = time.monotonic()
    found = pii_surrogates.find(text)
    assert len(found) == 3 * len(names) * 100 and time.monotonic() - started < 60


def test_years_and_round_numbers_are_no_phones():
    for text in ("Years 2001 2002 2003", "10 000 000 people", "from 1999-2001 2004", "some 1.250.000 rows"):
        assert [e for e in pii_surrogates.find(text) if e.kind == "phone"] == []
    for text in ("Call 988-555-2485", "Call +49 30 1234 5678", "Call (030) 555 0199", "Call 2001 555 0199"):
        assert [e.kind for e in pii_surrogates.find(text)] == ["phone"]


def test_full_forms_get_longer_or_are_an_error(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    canons = [("domain", f"{c}.co") for c in letters] + [("email", f"{c}@x.co") for c in letters]
    canons += [("ipv4", f"192.168.{i}.{j}") for i in range(140) for j in range(1, 255)]
    rows = spark.createDataFrame(canons, "kind string, canon string")
    out = pii_surrogates.assign_surrogates(rows, KEY).collect()
    new = {(r["kind"], r["new"]) for r in out}
    assert len(out) == len(new) == len(canons) and not new & set(canons)
    assert all(r["new"].startswith(("192.168.", "10.")) for r in out if r["kind"] == "ipv4")
    narrow = lambda key, kind, canon, attempt: str(attempt % 2)
    with pytest.raises(ValueError, match="no room .*: 3 of aws"):
        pii_surrogates.assign_surrogates(spark.createDataFrame([("aws", c) for c in "vwxyz"], rows.schema), KEY, narrow)


def test_hosts_stay_apart(spark):
    text = " ".join(f"me@{c}.co and you@{c}.co;" for c in "abcdefghijklmnopqrstuvwxyz")
    docs = spark.createDataFrame([(1, text), (2, "me@q.co")], "doc_id long, text string")
    out = by_id(pii_surrogates.replace_entities(docs, KEY))
    mails = re.findall(r"(\S+)@(\w+)\.co", out[1]["text"])
    hosts = [h for _, h in mails[::2]]
    assert hosts == [h for _, h in mails[1::2]] and len(set(hosts)) == 26 and all(len(h) > 1 for h in hosts)
    place = "abcdefghijklmnopqrstuvwxyz".index("q")
    assert out[2]["text"] == "@".join(mails[2 * place]) + ".co" and out[1]["n_entities"] == 52


def test_surrogates_of_odd_rows(spark, odd, none):
    out = pii_surrogates.replace_entities(odd, KEY)
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert pii_surrogates.replace_entities(none, KEY).count() == 0


# ---- 2 ----------------------------------------------------------------------------------------------------------


def passage(seed, n):
    return [f"line {seed} {i} of a passage" for i in range(n)]


def test_shifted_passages_are_removed_and_collisions_told_apart(spark):
    shared = passage("s", 40)
    texts = {i: passage(f"a{i}", i) + shared + passage(f"z{i}", 3) for i in range(1, 6)}
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id long, text string")
    full = by_id(line_chunks.remove_repeated_chunks(docs))
    assert full[1]["text"] == "\n".join(texts[1])
    for i in range(2, 6):
        kept = full[i]["text"].split("\n")
        assert len(set(kept) & set(shared)) <= 8
        assert [x for x in texts[i] if x not in shared] == [x for x in kept if x not in shared]
    # With two-bit hashes unlike texts collide; the result is the same.
    few = by_id(line_chunks.remove_repeated_chunks(docs, hash_bits=2))
    assert {k: r["text"] for k, r in few.items()} == {k: r["text"] for k, r in full.items()}


def test_line_dedup_of_odd_rows(odd, none):
    out = line_chunks.remove_repeated_chunks(odd)
    assert out.columns[:2] == ["doc_id", "text"] and out.count() == len(ODD)
    texts = sorted(str((r["doc_id"], r["text"])) for r in out.collect())
    assert texts == sorted(str(r[:2]) for r in ODD)
    assert line_chunks.remove_repeated_chunks(none).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_short_passages_between_differing_lines_are_removed_whole(spark, n):
    shared = [f"{s} {i} " + "a line of more than enough words to count for fifty " * 3 for s in "xy" for i in range(n)]
    one, two = shared[:n], shared[n:]
    own = [f"own line {i} that no other document has" for i in range(12)]
    texts = [own[:2] + one + own[2:4], own[4:5] + one + own[5:6] + two, own[6:9] + two + own[9:10] + one + own[10:]]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for bits in (64, 2):
        out = by_id(line_chunks.remove_repeated_passages(docs, hash_bits=bits))
        assert out[0]["text"] == "\n".join(texts[0])
        assert out[1]["text"].split("\n") == own[4:6] + two
        assert out[2]["text"].split("\n") == own[6:]
        assert [out[i]["n_removed"] for i in range(3)] == [0, n, 2 * n]
    staged = by_id(corpus_pipeline.without_repeated_lines(spark, docs, SF))
    assert {k: r["text"] for k, r in staged.items()} == {k: r["text"] for k, r in out.items()}


def test_passages_within_a_document_and_odd_rows(spark, odd, none):
    texts = ["a\na\na", "b\nb\nb\nb\nc", "d\n\n\ne\n\n\nf", "d\ng\nd\ng"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = by_id(line_chunks.remove_repeated_passages(docs))
    assert [out[i]["text"] for i in range(4)] == ["a\na\na", "b\nb\nc", "d\n\n\ne\n\n\nf", "d\ng"]
    rows = line_chunks.remove_repeated_passages(odd)
    assert sorted(str((r["doc_id"], r["text"])) for r in rows.collect()) == sorted(str(r[:2]) for r in ODD)
    assert line_chunks.remove_repeated_passages(none).count() == 0


def brute_passages(texts):
    """What is left of each text, by the rules, and the stretches that went."""
    lines = [t.split("\n") for t in texts]
    places = {}
    for d, own in enumerate(lines):
        for i, pair in enumerate(zip(own, own[1:])):
            if any(x.strip(" ") for x in pair):
                places.setdefault(pair, []).append((d, i))
    first = {p: places[pair][0] for pair in places if len(places[pair]) > 1 for p in places[pair]}
    seen, left, gone = set(), [], []
    for d, own in enumerate(lines):
        later = [i for i in range(len(own)) if (f := first.get((d, i))) and (f[0] != d or i >= f[1] + 2)]
        drop, start = set(), 0
        while start < len(later):
            end = start
            while end + 1 < len(later) and later[end + 1] == later[end] + 1:
                end += 1
            low, high = later[start], later[end] + 1
            src, at = first[d, low]
            along = {j for i in later[start : end + 1] if first[d, i] == (src, at + i - low) for j in (i, i + 1)}
            key = tuple(own[low : high + 1])
            if along == set(range(low, high + 1)) or key in seen:
                drop |= set(range(low, high + 1))
                gone.append("\n".join(key))
            else:
                seen.add(key)
            start = end + 1
        kept = {j for i in range(len(own)) if first.get((d, i)) == (d, i) for j in (i, i + 1)}
        left.append("\n".join(x for i, x in enumerate(own) if i not in drop - kept))
    return left, gone


def test_passages_survive_where_they_come_from(spark):
    """The third text is made of two sources, and is the source of the others."""
    texts = ["Q\nX\na", "b\nY\nR", "X\na\nb\nY", "K\na\nb\nM", "K2\na\nb\nM2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = by_id(line_chunks.remove_repeated_passages(docs))
    assert [out[i]["text"] for i in range(5)] == ["Q\nX\na", "b\nY\nR", "a\nb", "K\nM", "K2\nM2"]
    # Put together from two sources with a line in common: it stays where it comes first.
    texts = ["l1\nl2\nA", "l2\nl3\nB", "C\nl1\nl2\nl3\nC2", "D\nl1\nl2\nl3\nD2", "E\nl1\nl2\nE2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = by_id(line_chunks.remove_repeated_passages(docs))
    assert [out[i]["text"] for i in range(5)] == [*texts[:3], "D\nD2", "E\nE2"]


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    blocks = [[f"b{b} {i}" for i in range(int(rng.integers(2, 6)))] for b in range(6)]
    texts = []
    for d in range(60):
        own = []
        for _ in range(int(rng.integers(1, 5))):
            part = blocks[int(rng.integers(0, 6))]
            low = int(rng.integers(0, len(part)))
            own += part[low:] if rng.random() < 0.7 else [f"own {d} {rng.integers(0, 9)}", ""]
        texts.append("\n".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    left, gone = brute_passages(texts)
    for bits in (64, 3):
        out = by_id(line_chunks.remove_repeated_passages(docs, hash_bits=bits))
        assert [out[i]["text"] for i in range(60)] == left
    # Whatever went stands whole in what is left.
    assert len(gone) > 40
    assert all(any(f"\n{g}\n" in f"\n{t}\n" for t in left) for g in gone)


# ---- 3 ----------------------------------------------------------------------------------------------------------


def test_kernel_is_the_normalised_number_of_shared_grams():
    finder = language_id.Presence(3)
    a, b = finder.grams("The cat!"), finder.grams("a CAT")
    grams = lambda s: {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}
    assert len(a) == len(grams(" the cat ")) and len(np.intersect1d(a, b)) == len(grams(" the cat ") & grams(" a cat "))
    assert finder.grams("12 !?") is None and finder.grams(None) is None
    long = finder.grams("ab" * 2_000_000)
    assert len(long) == len(grams(" abababab "))


def test_languages_are_told_on_held_out_documents(spark):
    found = llm_queries()["op3_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(odd, none):
    model = language_id.fit(odd)
    out = language_id.identify(odd, model).collect()
    assert len(out) == len(ODD)
    assert all((r["lang_pred"] == "und") == (not r["text"] or not any(map(str.isalpha, r["text"]))) for r in out)
    empty = language_id.fit(none)
    assert {r["lang_pred"] for r in language_id.identify(odd, empty).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(3)
    rows = []
    for lang in range(140):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(12)]
        rows += [(None, " ".join(rng.choice(words, 30)), f"l{lang:03}") for _ in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, per_language=64)
    assert len(model.languages) == 140 and len(model.norms) == 280
    # Rows without an id are told apart by their texts, and the order of rows does not matter.
    again = language_id.fit(spark.createDataFrame(rows[::-1], docs.schema).repartition(5), per_language=64)
    assert np.array_equal(again.weights, model.weights)
    found = language_id.identify(docs, model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.97 * len(rows)


def test_language_model_is_the_direct_solution(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("lang is not null")
    model = language_id.fit(docs, per_language=40, n_landmarks=20)
    sample = language_id._sample(docs.where("text is not null"), 40).collect()
    finder = language_id.Presence(language_id.ORDER)
    grams = [(r["lang"], finder.grams(r["text"])) for r in sample]
    grams = [g for g in grams if g[1] is not None]
    kernels = model.kernel([g for _, g in grams])
    target = np.array([[lang == other for other in model.languages] for lang, _ in grams], float)
    weight = (1 / (len(model.languages) * target.sum(axis=0)))[target.argmax(axis=1)][:, None]
    # The ridge on Nyström features is one on the landmarks' kernel matrix. Landmarks are among the sample's rows.
    here = [kernels[np.flatnonzero(np.isclose(kernels[:, j], 1))[0]] for j in range(20)]
    own = np.array(here)
    left = kernels.T @ (weight * kernels) + language_id.RIDGE * (own + own.T) / 2
    assert kernels @ model.weights == pytest.approx(kernels @ np.linalg.lstsq(left, kernels.T @ (weight * target))[0], abs=1e-5)


def test_language_stage_keeps_short_texts_and_drops_unknown_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    more = [(-1, "Avec."), (-2, "De."), (-3, "Re."), (-4, "xqzv jkwx qqzz kvvq wxjz"), (-5, "..."), (-6, None)]
    more = spark.createDataFrame(more, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    docs = docs.unionByName(more)
    kept = by_id(corpus_pipeline.by_language(spark, docs, SF))
    found = by_id(language_id.identify(docs, language_id.fit(docs)))
    assert min(found[i]["score"] for i in (-1, -2, -3)) < corpus_pipeline.LEAST_SCORE
    assert sorted(i for i in kept if i < 0) == [-3, -2, -1]


# ---- 4 ----------------------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    html = [None, "", "same", "same", "ünï" * 5000, *[f"<p>{'text of page ' * 90}{i}</p>" for i in range(900)]]
    rows = [(i, f"http://x.org/a b/{i}" if i % 2 else None, h) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    dictionary = warc_zstd.train_dictionary(pages.select(F.encode("html", "UTF-8").alias("payload")))
    path = scratch_path(spark, "archives")
    warc_zstd.write_archives(warc_zstd.with_revisits(pages), path, dictionary, per_archive=100)
    out = {r["record_id"]: r for r in warc_zstd.read_archives(spark, path).collect()}
    assert dictionary and len(out) == len(rows) and not any(r["error"] for r in out.values())
    for i, _, h in rows:
        r, payload = out[f"<urn:page:{i}>"], (h or "").encode()
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == warc_zstd.payload_digest(payload)
        assert r["record_type"] == ("revisit" if i in (0, 2) else "response")
        assert r["payload"] is None if i in (0, 2) else bytes(r["payload"]) == payload
    assert out["<urn:page:2>"]["refers_to"] == "<urn:page:3>"


def test_archives_end_by_bytes(spark):
    rng = random.Random(5)
    sizes = [10, 40_000, 300, 90_000, 200_000, 5, 60_000, 30_000, 0, 100]
    rows = [(i, "u", "".join(rng.choices("abcdefghijklmnop", k=n))) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "cut-archives")
    records = warc_zstd.with_revisits(pages).coalesce(1)
    warc_zstd.write_archives(records, path, archive_bytes=50_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
    counts = [(f["length"], sum(1 for _ in warc_zstd.archive_frames(bytes(f["content"])))) for f in files]
    slack = 50 * len(warc_zstd.SEPARATOR)
    assert sum(n for _, n in counts) == len(rows) and len(counts) > 3
    assert all(size <= 50_000 + slack or n == 1 for size, n in counts) and any(n > 1 for _, n in counts)
    back = warc_zstd.read_archives(spark, path).collect()
    assert sorted(r["payload_bytes"] for r in back) == sorted(sizes) and not any(r["error"] for r in back)


def test_archives_of_others_are_read(spark, tmp_path):
    record = warc_zstd.record_bytes(7, "x://a", b"seven", None, False)
    whole = zstandard.ZstdCompressor().compress(record)
    opened = zstandard.ZstdCompressor().compressobj()
    unsized = opened.compress(record) + opened.flush()
    (tmp_path / "a.warc.zst").write_bytes(whole + unsized)
    (tmp_path / "b.warc.zst").write_bytes(b"")
    (tmp_path / "notes.md").write_bytes(b"no archive")
    rows = warc_zstd.read_archives(spark, str(tmp_path)).collect()
    assert [(r["record_type"], bytes(r["payload"]), r["error"]) for r in rows] == [("response", b"seven", None)] * 2
    assert warc_zstd.read_archives(spark, str(tmp_path), "*.md").first()["error"]
    bomb = zstandard.ZstdCompressor().compress(bytes(1 << 22))
    opened = zstandard.ZstdCompressor().compressobj()
    for data in (bomb, opened.compress(bytes(1 << 22)) + opened.flush()):
        with pytest.raises(warc_zstd.ArchiveError, match="holds over 1000000 bytes"):
            list(warc_zstd.archive_frames(data + whole, most=1_000_000))


def test_pages_of_odd_rows_round_trip(spark):
    rows = [(None, "u", "same"), (4, None, "same"), (4, "u", "same"), (2, "u", None), (3, "u", ""), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    for given in (pages, pages.limit(0)):
        path = scratch_path(spark, "odd-archives")
        warc_zstd.write_archives(warc_zstd.with_revisits(given), path)
        back = warc_zstd.read_archives(spark, path).collect()
        assert len(back) == given.count() and all(r["error"] is None for r in back)
    assert given.count() == 0


def test_broken_records_are_told():
    good = warc_zstd.record_bytes(1, "http://a/", b"body", None, False)
    assert warc_zstd.parse_record(good)["payload"] == b"body"
    for bad in (good[:-2], good.replace(b"body", b"bodY"), b"HTTP/1.1" + good[8:], good.replace(b"WARC-Date", b"Date")):
        with pytest.raises(warc_zstd.ArchiveError):
            warc_zstd.parse_record(bad)
    frame = zstandard.ZstdCompressor().compress(good)
    assert [f for _, f in warc_zstd.archive_frames(frame * 2)] == [good] * 2
    for bad in (frame[:-3], b"junkjunkjunk", frame + b"x"):
        with pytest.raises(warc_zstd.ArchiveError):
            list(warc_zstd.archive_frames(bad))


# ---- 5 ----------------------------------------------------------------------------------------------------------


def brute_scan(items, words, window):
    hit, found = set(), set()
    for item, w in items:
        k = min(window, len(w))
        for i in range(len(w) - k + 1):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
                    found.add(item)
    return hit, found


def test_automaton_finds_what_brute_force_finds():
    rng = np.random.default_rng(3)
    for trial in range(60):
        letters = [bytes([97 + c]) for c in range(2 + trial % 4)]
        draw = lambda n: [letters[i] for i in rng.integers(0, len(letters), n)]
        items = [(str(i), draw(int(rng.integers(1, 9)))) for i in range(5)]
        words = draw(60)
        spans, found = decontaminate.ItemAutomaton(items, 4).scan(words)
        hit, wanted = brute_scan(items, words, 4)
        assert {w for a, b in spans for w in range(a, b)} == hit and found == wanted


def test_passages_are_cut_and_clean_texts_stay(spark, odd, none):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item), (2, None), (None, "Two Words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before it. {item.upper()}. After, it."), (2, item), (3, "clean text")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert out == {1: "Before it. After, it.", 3: "clean text"}
    # A limit above the window spares shorter spans, unless they cover too much of the document.
    spared = decontaminate.decontaminate(docs, items, max_words=1000, max_coverage=1.0)
    assert spared.exceptAll(docs).count() == 0 and spared.count() == docs.count()
    assert decontaminate.find_contamination(odd, items).where(F.size("spans") > 0).count() == 0
    same = decontaminate.decontaminate(odd, items)
    assert same.columns == odd.columns and same.count() == len(ODD)
    assert decontaminate.find_contamination(odd, items.limit(0)).count() == len(ODD)
    assert decontaminate.decontaminate(none, items).count() == 0


def test_short_items_are_cut_whole(spark):
    own = " ".join(f"own{i}" for i in range(60))
    items = spark.createDataFrame([(1, "a b c d e f g h i"), (2, "x y")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{own} A b c d e f g h i. {own}"), (2, f"{own} x y {own}"), (3, "x y")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert out == {1: f"{own} {own}", 2: f"{own} x y {own}"}


# ---- 6 ----------------------------------------------------------------------------------------------------------


def test_pieces_rebuild_every_document(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [t for _, t, _, _ in ODD] + ["don't <|endoftext|> x", "e\u0301te\u0301 İS ŉ ½ x²", "🙂 ok_ok"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = packing.pack_documents(docs, path, pool_tokens=20_000).collect()
    for i, text in enumerate(texts):
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]
        assert np.frombuffer(b"".join(bytes(p["ids"]) for p in pieces), "<u4").tolist() == want
        assert all(p["doc_tokens"] == len(want) for p in pieces)
    for s in {r["sequence_id"] for r in rows}:
        parts = sorted((r for r in rows if r["sequence_id"] == s), key=lambda r: r["offset"])
        assert [p["offset"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts]])[:-1].tolist()
        total = sum(p["length"] for p in parts)
        assert total == parts[0]["tier"] <= packing.LONGEST and total & (total - 1) == 0
    assert packing.pack_documents(none, path).count() == 0


def test_step_groups_are_balanced():
    groups = packing.step_groups([4096] * 30 + [512] * 64 + [128] * 10, 16_384)
    loads = np.bincount(groups, weights=[4096] * 30 + [512] * 64 + [128] * 10)
    assert loads.max() - loads.min() <= 4096


# ---- 7 ----------------------------------------------------------------------------------------------------------


def brute_fingerprint(text, n=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_fingerprints_and_groups_of_odd_rows(odd, none):
    rows = simhash_pivots.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert sorted(r["fp"] % 2**64 for r in rows) == sorted(brute_fingerprint(t) for _, t, _, _ in ODD)
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {2}
    kept = simhash_pivots.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "1", "2", "5", "6", "7", "None", "None"])
    assert simhash_pivots.near_duplicates(none).count() == 0


def test_one_row_of_each_group_stays_whatever_its_ids(spark, odd, none):
    words = [f"w{i}" for i in range(200)]
    rows = [(5, " ".join(words), 1), (5, " ".join(words), 1), (5, " ".join(words), 2), (7, " ".join(words), 1)]
    rows += [(None, " ".join(words), 1), (None, "only without id", 1), (None, "only without id", 1), (None, "Only Without id", 2)]
    rows += [(9, "other text altogether", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    out = corpus_pipeline.without_near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["5", "9", "None"] and {tuple(r) for r in out} <= set(rows)
    kept = simhash_pivots.keep_single(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "6", "7", "None"]
    assert simhash_pivots.keep_single(none).count() == 0


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    marks = []
    for x in base:  # chains of small changes, and many close to one another
        for _ in range(12):
            marks.append(int(x))
            for bit in rng.integers(0, 63, int(rng.integers(1, 4))):
                x = int(x) ^ (1 << int(bit))
    rows = list(enumerate(marks))
    out = {r["fp"]: r["component_id"] for r in simhash_pivots.fingerprint_components(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    linked = [(a, b) for a, x in rows for b, y in rows if a < b and ((x ^ y) % 2**64).bit_count() <= 2]
    want = brute_groups(range(len(rows)), linked)
    assert all(out[x] == want[i] for i, x in rows)


def test_connected_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(900, 901), (None, 5), (7, 7)], "a long, b long")
    out = by_id(connected_components(edges.unionByName(more), "a", "b"), "node")
    assert len(out) == 303 and {r["component"] for k, r in out.items() if k < 900} == {0} and out[901]["component"] == 900


# ---- 8 ----------------------------------------------------------------------------------------------------------


def test_urls(spark):
    urls = [
        ("http://A.Example.ORG/es/x?q", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("x://example.org/en/17#f", "example.org", "/en/17", "example.org/en/1", "block"),
        ("x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("x://b.com/fr/xxx", "b.com", "/fr/xxx", "com/fr/", "allow"),
        ("x://b.net/a-xxx-b", "b.net", "/a-xxx-b", None, "block"),
        ("x://sussex.net/sex", "sussex.net", "/sex", None, "allow"),
        ("x://b.net/c?casino=1&p=P%6Fker", "b.net", "/c", None, "block"),
        ("x://b.net/sex/sex", "b.net", "/sex/sex", None, "allow"),
        ("x://b.org?xxx", "b.org", "", None, "block"),
        (None, "", "", None, "allow"),
        ("no scheme.org/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u[0], "rule") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    out = by_id(url_vocabulary.filter_urls(pages, URL_RULES), "page_id")
    assert [tuple(out[i][c] for c in ("host", "path", "rule", "verdict")) for i in range(len(urls))] == [u[1:] for u in urls]
    assert url_vocabulary.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_terms_of_other_languages(spark):
    urls = ["x://a.es/apuestas-y-ruleta", "x://a.de/wetten", "x://a.fr/paris-sportifs/roulette", "x://a.it/pornografia", "x://a.pt/sexologia/nuance"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = by_id(url_vocabulary.filter_urls(pages, []), "page_id")
    assert [out[i]["verdict"] for i in range(5)] == ["block", "allow", "block", "block", "allow"]
    assert not set(url_vocabulary.STRICT) & set(url_vocabulary.SOFT)


def test_terms_fit_in_any_case_and_odd_rows_are_judged(spark):
    long = "x://h.net/" + "a/" * 1_000_000 + "Casino"
    rows = [(None, "x://h.net/WAREZ"), (1, long), (1, long), (2, None), (3, "x://H.net/casino/Poker")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("odd"))
    out = url_vocabulary.filter_urls(pages, [], ("Warez", "Poker"), ("CASINO", "poker")).collect()
    told = sorted((r["page_id"] or 0, r["verdict"], r["strict_hits"], r["soft_terms"]) for r in out)
    assert told == [(0, "block", 1, []), (1, "allow", 0, ["casino"]), (1, "allow", 0, ["casino"]), (2, "allow", 0, []), (3, "block", 1, ["casino"])]


# ---- 9 ----------------------------------------------------------------------------------------------------------


def test_links_have_recall_and_no_false_pair(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(32)
        for _ in range(10):
            rows.append(centre + rng.standard_normal(32) * 0.16)
    rows += [np.ones(32), np.ones(32), np.ones(32) * 2, np.zeros(32)]
    data = [(i, [float(x) for x in v], 1) for i, v in enumerate(rows)]
    data += [(900, None, 1), (901, [], 1), (902, [float("nan")] * 32, 1), (903, [1.0, None], 1), (904, [1.0, 1.0], 1)]
    out = by_id(pivot_permutation.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, kept int"), block_rows=4), "vec_id")
    x = np.array(rows[:-1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = np.array([out[i]["n_links"] for i in range(len(true))])
    assert (got <= true).all() and got.sum() >= 0.97 * true.sum() and len(out) == len(data)
    assert out[300]["n_links"] == 2 and out[302]["component_id"] == 300 and not out[302]["kept"]
    for i in (303, 900, 901, 902, 903, 904):
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_permutation.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("sides", [False, True])
def test_pairs_of_a_list_are_verified_where_they_meet_first(sides):
    rng = np.random.default_rng(8)
    n, shared, last = 1300, 3, 12
    vectors = rng.standard_normal((1, 16)) + 0.25 * rng.standard_normal((n, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    others = [c for c in range(30) if c not in (4, 9, last)]
    near = np.array([[4, 9, last, *rng.choice(others, 5, replace=False)] for _ in range(n)], np.int32)
    side = np.arange(n) % 2 if sides else None
    a, b = pivot_permutation._links(vectors, near, last, shared, 0.95, side)
    codes = [set(row) for row in near.tolist()]
    want = {
        (i, j)
        for i, j in zip(*np.nonzero(np.triu(vectors @ vectors.T >= 0.95, 1)))
        if sorted(codes[i] & codes[j])[:shared] == [4, 9, last] and (not sides or (i - j) % 2)
    }
    assert len(a) == len(want) > 1000 and set(zip(a.tolist(), b.tolist())) == want


def test_vectors_without_id_count_as_links(spark):
    rng = np.random.default_rng(11)
    a = rng.normal(size=16)
    near = a + 0.001 * rng.normal(size=16)
    data = [(1, a.tolist()), (None, near.tolist()), (None, near.tolist()), (2, rng.normal(size=16).tolist()), (None, (-a).tolist())]
    data.append((3, (near + 0.001 * rng.normal(size=16)).tolist()))
    rows = pivot_permutation.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows if r["vec_id"] is not None}
    assert out == {1: (3, 1, True), 2: (0, 2, True), 3: (3, 1, False)}
    assert sorted(r["n_links"] for r in rows if r["vec_id"] is None) == [0, 3, 3]
    assert all(r["component_id"] is None and not r["kept"] for r in rows if r["vec_id"] is None)


# ---- 10 ---------------------------------------------------------------------------------------------------------


def test_shards_hold_nearly_equal_bytes(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = virtual_slots.shard_documents(docs, 40, scratch_path(spark, "map")).collect()
    loads, places = np.zeros(40), {}
    for r in rows:
        loads[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert loads.max() / loads.mean() < 1.05
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    out = virtual_slots.shard_documents(odd, 3, scratch_path(spark, "map")).collect()
    assert sorted(r["size"] for r in out) == sorted(len((t or "").encode()) + 16 for _, t, _, _ in ODD)
    assert all(r["text_crc32"] == 0 for r in out if r["size"] == 16)
    assert virtual_slots.shard_documents(none, 3, scratch_path(spark, "map")).count() == 0


def test_equal_rows_are_spread(spark):
    """Half of the rows are equal, without id and text, and half are not; 100,000 rows of one key and one number."""
    n = 50_000
    docs = spark.range(2 * n).select(F.when(F.col("id") >= n, F.col("id")).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    path = scratch_path(spark, "map")
    rows = virtual_slots.shard_documents(docs, 10, path)
    found = rows.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    loads = np.array([r["bytes"] for r in found])
    assert loads.max() <= 1.05 * loads.mean() and loads.min() >= 0.95 * loads.mean()
    assert all(r["n"] == r["slots"] == r["last"] + 1 for r in found)
    # Again on the same map: it is edited, under a new version.
    virtual_slots.shard_documents(docs, 11, path)
    assert virtual_slots.map_versions(spark, path) == [1, 2]
    first, second = (virtual_slots.read_map(spark, path, v)[1] for v in (1, 2))
    assert len(first) == virtual_slots.SLOTS and sum(a != b for a, b in zip(first, second)) < virtual_slots.SLOTS / 5
    with pytest.raises(ValueError, match="version 2 already"):
        virtual_slots.store_map(spark, path, 2, first, first)


def test_map_is_edited_not_made_anew(spark):
    rng = np.random.default_rng(2)
    sizes = [int(x) for x in rng.integers(1, 1000, 512)]
    first = virtual_slots.first_map(sizes, 8)
    path = scratch_path(spark, "map")
    virtual_slots.store_map(spark, path, 1, first, sizes)
    grown = virtual_slots.rebalanced(first, sizes, 9)
    virtual_slots.store_map(spark, path, 2, grown, sizes)
    assert virtual_slots.read_map(spark, path)[:2] == (2, grown) and virtual_slots.read_map(spark, path, 1)[1] == first
    loads = np.bincount(grown, weights=sizes, minlength=9)
    assert loads.max() <= 1.02 * loads.mean() and sum(a != b for a, b in zip(first, grown)) < 512 / 4
    smaller = virtual_slots.rebalanced(grown, sizes, 5)
    assert set(smaller) == set(range(5)) and np.bincount(smaller, weights=sizes).max() <= 1.02 * sum(sizes) / 5


# ---- pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        path = scratch_path(spark, "stage")
        after.write.parquet(path)
        before = spark.read.parquet(path)
    kept = {r["doc_id"]: r["text"] for r in before.collect()}
    assert all(len(t) == n for t, n in [(r["text"], r["n_chars"]) for r in before.collect()])
    marks = {i: brute_fingerprint(t) for i, t in kept.items()}
    assert all((a ^ b).bit_count() > 2 for i, a in marks.items() for j, b in marks.items() if i < j)
    pieces = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == set(kept)
    con = duckdb.connect()
    n = con.execute(f"SELECT count(*) FROM read_parquet('{SF}/documents.parquet')").fetchall()[0][0]
    assert len(kept) > 0.85 * n


def test_line_stage_goes_by_chunks_after_passages(spark, monkeypatch):
    """The stage runs the content-defined chunks over all documents as passages leave them."""
    lines = [f"line {i} of a text that several documents share" for i in range(30)]
    texts = ["\n".join(lines), "\n".join(["first of its own", *lines[4:25], "last of its own"]), "\n".join(lines[10:])]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    given, chunks = [], line_chunks.remove_repeated_chunks
    monkeypatch.setattr(line_chunks, "remove_repeated_chunks", lambda d: given.append(by_id(d)) or chunks(d))
    out = by_id(corpus_pipeline.without_repeated_lines(spark, docs, SF))
    left = by_id(line_chunks.remove_repeated_passages(docs))
    assert [{k: r["text"] for k, r in g.items()} for g in given] == [{k: r["text"] for k, r in left.items()}]
    assert out[0]["text"] == texts[0] and out[1]["text"] == "first of its own\nlast of its own" and out[2]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())
    # Chunks have the last word: what they find, goes.
    monkeypatch.setattr(line_chunks, "remove_repeated_passages", lambda d: d)
    alone = by_id(corpus_pipeline.without_repeated_lines(spark, docs, SF))
    assert {k: r["text"] for k, r in alone.items()} == {k: r["text"] for k, r in by_id(chunks(docs)).items()}
    assert len(alone[1]["text"]) < len(texts[1]) / 2
