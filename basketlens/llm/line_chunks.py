"""Line dedup by content-defined chunks of lines, or by all passages of lines, in DataFrame functions only.

A document's lines are hashed; a rolling hash covers the last ``ROLL`` of these line hashes. A chunk ends after
a line whose rolling hash is smaller than its neighbours' on both sides. As that depends on a few lines around
the boundary only, boundaries move with the text when lines are put in or taken out before it, and a chunk has
two lines at least, but for the last of a document. Chunks of two or more lines that occur more than
once, in one document or in several, stay where they come first (smallest doc_id, then first in the text) and are
removed elsewhere.

Only hashes and places are grouped to find repeated chunks. The texts of those, and of no others, are then
grouped by their bytes. Should a hash have more than one text, its places are decided by the texts themselves.
What is known of each document grows with the corpus, so it is joined by sorting, never broadcast.

Chunks miss repeated passages that hold few boundaries. Passages are found by overlapping pieces instead: every line
with the line after it. Pieces that follow each other here and at their first occurrences make up a passage, which so grows
line by line until the texts differ, wherever it begins or ends. The first occurrence of a repeated piece is a source and
keeps its lines. A stretch of repeated pieces goes if the whole of it stands at its sources in one row; one that is put
together from several places stays where it comes first, and goes elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import put_back, set_aside
from basketlens.plans.workspace import written

# Line hashes in the rolling hash, its base and its modulus (a prime; the products stay below 2^63).
ROLL = 2
BASE = 1_000_003
MODULUS = 2_147_483_647


def _line_hash(line: Column) -> Column:
    """The first 31 bits of MD5: the same everywhere, also in SQL."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long").bitwiseAND(0x7FFFFFFF)


def _roll(hashes: Column, i: Column) -> Column:
    """Polynomial over line hashes i, i-1, …; places before the first line count as 0."""
    total = F.lit(0).cast("long")
    for k in range(ROLL):
        before = F.when(i >= k, F.get(hashes, i - k)).otherwise(F.lit(0).cast("long"))
        total = total + before % MODULUS * F.lit(BASE**k % MODULUS) % MODULUS
    return total % MODULUS


def with_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` (_id, _mark, text, …) with ``_lines`` and ``_chunks``: array of (start, length) in lines."""
    lines = docs.withColumn("_lines", F.split("text", "\n", -1))
    hashed = lines.withColumn("_hashes", F.transform("_lines", _line_hash))
    rolled = hashed.withColumn("_roll", F.transform("_hashes", lambda _, i: _roll(F.col("_hashes"), i)))
    n = F.size("_lines")

    def ends(i: Column) -> Column:
        """Whether a chunk ends after line i."""
        here, before, after = (F.get("_roll", j) for j in (i, i - 1, i + 1))
        return (i == n - 1) | ((i > 0) & (here < before) & (here <= after))

    stops = F.filter(F.sequence(F.lit(0), n - 1), ends)
    chunked = rolled.withColumn("_ends", stops).withColumn(
        "_chunks",
        F.transform(
            "_ends",
            lambda end, k: F.struct(
                F.when(k == 0, F.lit(0)).otherwise(F.get("_ends", k - 1) + 1).alias("start"),
                (end - F.when(k == 0, F.lit(-1)).otherwise(F.get("_ends", k - 1))).alias("length"),
            ),
        ),
    )
    return chunked.drop("_hashes", "_roll", "_ends")


def with_pairs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_lines`` and ``_chunks`` as of :func:`with_chunks`: at each line the piece of it and the next.

    A piece of blank lines only is no passage, so it has length 1 like that of the last line.
    """
    lines = docs.withColumn("_lines", F.split("text", "\n", -1))
    n = F.size("_lines")

    def piece(line: Column, i: Column) -> Column:
        blank = (F.trim(line) == "") & (F.trim(F.get("_lines", i + 1)) == "")
        return F.struct(i.alias("start"), F.when((i < n - 1) & ~blank, F.lit(2)).otherwise(F.lit(1)).alias("length"))

    return lines.withColumn("_chunks", F.transform("_lines", piece))


def _text(chunk: Column) -> Column:
    return F.array_join(F.slice("_lines", chunk["start"] + 1, chunk["length"]), "\n")


def _places(chunked: DataFrame, hash_bits: int) -> DataFrame:
    """(_id, _mark, pos, hash): one row per chunk of two or more lines."""
    drop = 64 - hash_bits
    rows = chunked.select(
        "_id",
        "_mark",
        F.posexplode(
            F.transform(
                "_chunks",
                lambda c: F.when(c["length"] >= 2, F.shiftright(F.xxhash64(_text(c)), drop)),
            )
        ).alias("pos", "hash"),
    )
    return rows.where(F.col("hash").isNotNull())


def _known_places(docs: DataFrame, hash_bits: int, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(_id, _mark, pos, first) of every repeated chunk that ``cut`` makes of ``docs`` (_id, _mark, text), the first ones included."""
    order = F.struct("_id", "_mark", "pos")
    places = written(_places(cut(docs), hash_bits), "chunk-places")
    known = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    known = written(known.where("n > 1").select("hash", "first"), "repeated-hashes")
    marked = written(places.join(known, "hash"), "marked-places")

    # Byte comparison: the texts of repeated hashes, each once per task, grouped by their bytes.
    wanted = marked.groupBy("_id", "_mark").agg(F.collect_set(F.struct("pos", "hash")).alias("_wanted"))
    lined = docs.where(F.contains("text", F.lit("\n")))
    found = F.transform(
        "_wanted", lambda w: F.struct(w["pos"], w["hash"], _text(F.get("_chunks", w["pos"])).alias("chunk"))
    )
    texts = cut(lined.join(wanted.hint("merge"), ["_id", "_mark"])).select("_id", "_mark", F.inline(found))
    groups = texts.groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    groups = written(groups, "chunk-texts")
    unlike = groups.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("hash")
    unlike = written(unlike, "unlike-hashes")

    # A hash with one text: all its places are copies of the first. With more texts, which hardly happens: per text.
    every = marked.select("_id", "_mark", "pos", "first")
    if not unlike.isEmpty():
        several = groups.where("n > 1").select("hash", "chunk", "first")
        told_apart = texts.join(unlike, "hash").join(several, ["hash", "chunk"])
        sure = marked.join(unlike, "hash", "left_anti")
        every = sure.select(*every.columns).unionByName(told_apart.select(*every.columns))
    return every


def _elsewhere() -> Column:
    return (F.col("_id") != F.col("first._id")) | (F.col("_mark") != F.col("first._mark"))


def repeated_places(
    docs: DataFrame, hash_bits: int = 64, cut: Callable[[DataFrame], DataFrame] = with_chunks
) -> DataFrame:
    """(_id, _mark, pos): the chunks to remove from ``docs`` (_id, _mark, text); ``cut`` makes the chunks."""
    every = _known_places(docs, hash_bits, cut)
    return every.where(_elsewhere() | (F.col("pos") > F.col("first.pos"))).select("_id", "_mark", "pos")


def _repeated_stretches(every: DataFrame) -> DataFrame:
    """(_id, _mark, start, n): stretches of n pieces, that is n + 1 lines, that stand elsewhere in a row and can go.

    ``every`` is a stored table of :func:`_known_places` over pairs of lines.
    """
    # Of equal lines in a row the first two stay: what overlaps the first piece is no other occurrence of it.
    later = every.where(_elsewhere() | (F.col("pos") >= F.col("first.pos") + 2))
    own = later.groupBy("_id", "_mark", "pos").agg(F.first("first").alias("first"))
    in_doc = Window.partitionBy("_id", "_mark").orderBy("pos")
    new = F.coalesce(F.col("pos") != F.lag("pos").over(in_doc) + 1, F.lit(True)).cast("int")
    placed = own.withColumn("stretch", F.sum(new).over(in_doc))
    in_stretch = Window.partitionBy("_id", "_mark", "stretch").orderBy("pos")
    shift = F.struct("first._id", "first._mark", (F.col("pos") - F.col("first.pos")).alias("shift"))
    # Only the place that the first piece comes from can hold the whole stretch. It does if its pieces cover all lines.
    along = placed.withColumn("along", (shift == F.first(shift).over(in_stretch)).cast("int"))
    begins = F.col("along") * (1 - F.coalesce(F.lag("along").over(in_stretch), F.lit(0)))
    along = along.withColumn("begins", begins)
    stretches = written(
        along.groupBy("_id", "_mark", "stretch").agg(
            F.min("pos").alias("start"),
            F.count(F.lit(1)).alias("n"),
            (F.sum("along") + F.sum("begins")).alias("covered"),
            F.when(F.sum("along") + F.sum("begins") <= F.count(F.lit(1)), F.sort_array(F.collect_list(F.struct("pos", "first")))).alias(
                "pieces"
            ),
        ),
        "line-stretches",
    )
    whole = stretches.where("covered = n + 1").select("_id", "_mark", "start", "n")
    # Equal stretches have the same pieces, each known by its first occurrence.
    mixed = stretches.where("covered <= n").withColumn("pieces", F.transform("pieces", lambda p: p["first"]))
    place = F.struct("_id", "_mark", "start")
    sources = mixed.groupBy("pieces").agg(F.min(place).alias("source"))
    again = mixed.join(sources, "pieces").where(place != F.col("source"))
    return whole.unionByName(again.select("_id", "_mark", "start", "n"))


def _parts(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``own`` as (_row, text, _id, _mark): the rows with doc_id and text, and the others."""
    keyed = own.select(
        set_aside(own).alias("_row"), "text", F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_mark")
    )
    part = keyed.where(F.col("_id").isNotNull() & F.col("text").isNotNull())
    return part, keyed.where(F.col("_id").isNull() | F.col("text").isNull())


def remove_repeated_chunks(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """``docs`` (doc_id, text, …) with repeated multi-line chunks removed from ``text``, and three counts.

    Adds ``n_lines``, ``n_chunks`` and ``n_removed`` (chunks removed; columns of these names are replaced). All
    rows stay, also those whose text becomes empty. Rows with equal doc_id and text are the same document and get
    the same result. Rows without doc_id or text take no part and stay as they are, with counts of 0. An
    empty text is one empty line. ``hash_bits`` shortens the chunk hash, to test hashes with unlike texts.
    """
    own = docs.drop("n_lines", "n_chunks", "n_removed")
    part, rest = _parts(own)
    gone = repeated_places(part.select("_id", "_mark", "text"), hash_bits)
    by_doc = written(gone.groupBy("_id", "_mark").agg(F.collect_set("pos").alias("_gone")), "removals")
    chunked = with_chunks(part.join(by_doc.hint("merge"), ["_id", "_mark"], "left"))
    n = F.size("_chunks")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "_gone")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda k: _text(F.get("_chunks", k))), "\n")
    )
    done = chunked.select(
        *put_back(own.columns, "_row", text),
        F.size("_lines").cast("long").alias("n_lines"),
        n.cast("long").alias("n_chunks"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    zero = F.lit(0).cast("long")
    counts = [zero.alias(c) for c in ("n_lines", "n_chunks", "n_removed")]
    return done.unionByName(rest.select(*put_back(own.columns, "_row"), *counts))


def remove_repeated_passages(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """``docs`` (doc_id, text, …) without the lines of passages that occur earlier, and two counts.

    A passage is two or more lines, not all blank, that stand in the same order with the same bytes in a document
    before (smallest doc_id) or farther up in the same one. What goes still stands somewhere: every pair of lines that
    occurs more than once is kept at its first occurrence, and every stretch that goes is kept whole elsewhere, in one row.
    Adds ``n_lines`` and ``n_removed`` (lines removed; columns of these names are replaced). Rows, odd rows and
    ``hash_bits`` are treated as by :func:`remove_repeated_chunks`.
    """
    own = docs.drop("n_lines", "n_removed")
    part, rest = _parts(own)
    every = written(_known_places(part.select("_id", "_mark", "text"), hash_bits, with_pairs), "piece-places")
    stretches = _repeated_stretches(every)
    lines = F.flatten(F.collect_list(F.sequence("start", (F.col("start") + F.col("n")).cast("int"))))
    removable = stretches.groupBy("_id", "_mark").agg(lines.alias("_lines_gone"))
    at_source = every.where(~_elsewhere() & (F.col("pos") == F.col("first.pos")))
    sources = at_source.groupBy("_id", "_mark").agg(F.collect_set("pos").alias("_source"))
    by_doc = removable.join(sources.hint("merge"), ["_id", "_mark"], "left")
    source = F.coalesce("_source", F.array().cast("array<int>"))
    protected = F.array_union(source, F.transform(source, lambda i: i + 1))
    by_doc = written(by_doc.select("_id", "_mark", F.array_except("_lines_gone", protected).alias("_gone")), "removals")
    joined = part.join(by_doc.hint("merge"), ["_id", "_mark"], "left").withColumn("_lines", F.split("text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    )
    done = joined.select(
        *put_back(own.columns, "_row", text),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    counts = [F.lit(0).cast("long").alias(c) for c in ("n_lines", "n_removed")]
    return done.unionByName(rest.select(*put_back(own.columns, "_row"), *counts))
