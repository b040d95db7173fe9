"""Repeated substrings by the common-prefix interval tree of an enhanced suffix array, cut into buckets.

A string of ``min_length`` bytes is found by its anchor: the 8 to 32 bytes in it with the smallest hash, the first among equals.
Equal strings have equal anchors, so only suffixes that begin within reach of equal anchors are ever compared. Consecutive
suffixes with one anchor form a context: their beginnings and what they need to be compared. A context whose anchor
stands nowhere else goes; equal contexts are one, with their first occurrence and their number. The contexts of an
anchor are a bucket of the suffix array.

A task sorts the suffixes of its buckets by prefix doubling, takes the common prefixes of neighbours, and scans them with
a stack. Every interval of suffixes that share ``min_length`` bytes or more is a node of a tree. It is a maximal repeat if
the bytes before its suffixes differ (left-extension diversity); if they do not, the same occurrences are in the node of the
suffixes one byte to the left. A node lists its occurrences but for those that a node within it lists already, of which it has
the first; so the lists together are as long as the input, and yet a node's whole list can be read from the nodes inside it.

A bucket with more than ``bucket_contexts`` different contexts, such as that of a line that stands in a third of all
documents, is refined by the first ``min_length`` bytes of its suffixes before it is sorted. Its suffixes then meet by hashes of
these bytes, and the first and the number of each are aggregated before they are moved.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import put_back, set_aside
from basketlens.plans.numbering import number_rows
from basketlens.plans.workspace import drop_written, written

MIN_LENGTH = 100
# Contexts of one anchor that a task sorts; a bucket with more is refined first.
BUCKET_CONTEXTS = 2_000
# Suffixes whose anchors are found at a time, and bytes of contexts sorted at a time.
_STRETCH = 1 << 18
_SORTED_BYTES = 1 << 18
# Bytes of text whose contexts are not worth more than one task and file of an intermediate table.
_TASK_BYTES = 32 << 20
_PLACE_BITS = 26
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
# A place is the first suffix of a context and the number of its suffixes.
_COUNT_BITS = 16


# ---- anchors --------------------------------------------------------------------------------------------


def _words_of(min_length: int) -> int:
    """Words of eight bytes in an anchor: more tell more apart, fewer leave more strings to one anchor."""
    if not 8 <= min_length < 1 << _COUNT_BITS:
        raise ValueError("repeats must have from 8 to 65,535 bytes")
    return min(4, max(1, min_length // 16))


def _gram_hashes(octets: np.ndarray, words: int) -> np.ndarray:
    """A hash of the ``words`` * 8 bytes from each position on."""
    view = np.lib.stride_tricks.as_strided(octets[:8].view(np.uint64), (len(octets) - 7,), (1,)).copy()
    n = len(octets) - 8 * words + 1
    out = view[:n] * _MIX[0]
    for i in range(1, words):
        out += view[8 * i : 8 * i + n] * _MIX[i]
    out ^= out >> np.uint64(32)
    out *= _MIX[0]
    out ^= out >> np.uint64(29)
    return out


def _anchors(octets: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, and for each string of ``min_length`` bytes the position of its anchor."""
    words = _words_of(min_length)
    hashes = _gram_hashes(octets, words)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width, have = min_length - 8 * words + 1, 1
    while 2 * have <= width:
        least, have = np.minimum(least[have:], least[:-have]), 2 * have
    if rest := width - have:
        least = np.minimum(least[rest:], least[:-rest])
    return hashes, (least & low).astype(np.int64)


def contexts_of(octets: np.ndarray, offsets: np.ndarray, min_length: int) -> tuple[np.ndarray, ...]:
    """(text, start, count, anchor) of the contexts of concatenated texts; starts are positions in ``octets``."""
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, len(octets) - min_length + 1), _STRETCH):
        hashes, place = _anchors(octets[at : at + _STRETCH + min_length - 1], min_length)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        past = np.append(first[1:], len(place)) + at
        anchor = place[first] + at
        text = np.searchsorted(offsets, anchor, side="right") - 1
        # Strings that reach over the end of a text are none.
        start = np.maximum(first + at, offsets[text])
        past = np.minimum(past, offsets[text + 1] - min_length + 1)
        go = past > start
        gram = (hashes[place[first]] >> np.uint64(16)).astype(np.int64)
        out.append((text[go], start[go], (past - start)[go], gram[go]))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*out))


def _octets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    octets = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return octets[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch by stretches of the bytes in its second column; a row stays whole."""
    _, offsets = _octets(batch.column(1))
    edges = np.flatnonzero(np.diff(offsets[:-1] // _STRETCH, prepend=-1, append=-1)).tolist()
    for begin, end in zip(edges, edges[1:]):
        yield batch.slice(begin, end - begin)


def _all_contexts(
    min_length: int, whole: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(gram), or with ``whole`` (gram, mark, _doc, place), of every context of rows (_doc, _bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole_batch in batches if len(whole_batch) for part in _parts(whole_batch)):
            octets, offsets = _octets(batch.column(1))
            text, start, count, gram = contexts_of(octets, offsets, min_length)
            if not whole:
                yield pa.RecordBatch.from_arrays([pa.array(gram)], ["gram"])
                continue
            buffer, digest = memoryview(octets), xxhash.xxh64_intdigest
            ends = start + count + min_length - 1
            marks = np.fromiter(
                (digest(buffer[a:b]) for a, b in zip(start.tolist(), ends.tolist())), np.uint64, len(start)
            )
            place = (start - offsets[text]) << _COUNT_BITS | count
            doc = batch.column(0).to_numpy()[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (gram, marks.view(np.int64), doc, place)], ["gram", "mark", "_doc", "place"]
            )

    return run


# ---- the interval tree ----------------------------------------------------------------------------------


class Suffixes:
    """The enhanced suffix array of some contexts: suffixes that begin in the first ``counts`` bytes of each, by bucket."""

    def __init__(self, bodies: list[bytes], counts: np.ndarray, buckets: np.ndarray) -> None:
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        starts = np.cumsum(sizes + 1) - sizes - 1
        octets = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
        here = np.arange(len(octets))
        context = np.repeat(np.arange(len(bodies)), sizes + 1)
        self.end = (starts + sizes)[context]
        self.symbol = octets.astype(np.int64) + 1
        self.symbol[starts + sizes] = 0
        levels = [(7, self._ranked(self._sevens(here)))]
        while levels[-1][0] < sizes.max():
            length, rank = levels[-1]
            after = rank[np.minimum(here + length, self.end)]
            levels.append((2 * length, self._ranked(rank << 32 | after)))
        self.levels = levels
        own = np.flatnonzero(here - starts[context] < counts[context])
        by_rank = np.argsort(buckets[context[own]] << 32 | levels[-1][1][own], kind="stable")
        #: Positions of the suffixes in order, their contexts, and how far into these they begin.
        self.position = own[by_rank]
        self.context = context[self.position]
        self.inside = self.position - starts[self.context]
        bucket = buckets[self.context]
        #: Common prefix of each suffix with the next, none across buckets.
        self.common = np.where(bucket[1:] == bucket[:-1], self._common(), 0)
        # What stands before a suffix; at the front of a context nothing is like it.
        before = self.symbol[np.maximum(self.position - 1, 0)]
        self.left = np.where(self.inside > 0, before, 1000 + self.context)

    def _sevens(self, here: np.ndarray) -> np.ndarray:
        key = self.symbol
        for i in range(1, 7):
            key = key << 9 | self.symbol[np.minimum(here + i, self.end)]
        return key

    @staticmethod
    def _ranked(keys: np.ndarray) -> np.ndarray:
        return np.unique(keys, return_inverse=True)[1].astype(np.int64)

    def _common(self) -> np.ndarray:
        a, b = self.position[:-1], self.position[1:]
        end_a, end_b = self.end[a], self.end[b]
        n = np.zeros(len(a), np.int64)
        for length, rank in reversed(self.levels):
            n += length * (rank[np.minimum(a + n, end_a)] == rank[np.minimum(b + n, end_b)])
        same = np.ones(len(a), bool)
        for _ in range(6):
            same &= self.symbol[np.minimum(a + n, end_a)] == self.symbol[np.minimum(b + n, end_b)]
            n += same
        return np.minimum(n, np.minimum(end_a - a, end_b - b))


_MANY = -1


def repeat_nodes(
    suffixes: Suffixes, order: np.ndarray, copies: np.ndarray, min_length: int
) -> Iterator[tuple[int, int, int, int, list[int], int]]:
    """(first row, last row, length, occurrences, listed rows, first listed) of each maximal repeat.

    Rows are those of the suffix array; ``order`` is their order in the corpus, ``copies`` how often each stands for.
    """
    long = suffixes.common >= min_length
    if not long.any():
        return
    edges = np.diff(np.concatenate(([0], long.astype(np.int8), [0])))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    # A run of suffixes that are all preceded by one byte has no maximal repeat.
    unlike = np.concatenate(([0], np.cumsum(long & (suffixes.left[1:] != suffixes.left[:-1]))))
    diverse = unlike[end] > unlike[begin]
    common, left = suffixes.common, suffixes.left
    for lo, hi in zip(begin[diverse].tolist(), end[diverse].tolist()):
        own, before = order[lo : hi + 1].tolist(), left[lo : hi + 1].tolist()
        times, prefix = copies[lo : hi + 1].tolist(), common[lo:hi].tolist()
        # Open nodes: length, first row, what stands before (or _MANY), occurrences, listed, the first of them.
        stack: list[list] = []

        def add(node: list, part: list) -> None:
            if node[2] != part[2]:
                node[2] = _MANY
            node[3] += part[3]
            node[4] += part[4]
            if own[part[5] - lo] < own[node[5] - lo]:
                node[5] = part[5]

        for row in range(lo, hi + 1):
            length = prefix[row - lo] if row < hi else 0
            part = [0, row, before[row - lo], times[row - lo], [row], row]
            while stack and stack[-1][0] > length:
                node = stack.pop()
                add(node, part)
                if node[2] == _MANY:
                    yield node[1], row, node[0], node[3], node[4], node[5]
                    node[4] = [node[5]]
                part = node
            if stack and stack[-1][0] == length:
                add(stack[-1], part)
            elif row < hi:
                stack.append([length, *part[1:4], list(part[4]), part[5]])


def _scanned(min_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (gram, _doc, place, copies, body) come sorted by anchor; whole buckets are sorted together, many at a time."""

    def scan(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        gram, doc, place, copies = (table[c].to_numpy() for c in ("gram", "_doc", "place", "copies"))
        bucket = np.unique(gram, return_inverse=True)[1].astype(np.int64)
        suffixes = Suffixes(table["body"].to_pylist(), place & ((1 << _COUNT_BITS) - 1), bucket)
        context = suffixes.context
        start = (place >> _COUNT_BITS)[context] + suffixes.inside
        order = np.empty(len(context), np.int64)
        order[np.lexsort((start, doc[context]))] = np.arange(len(context))
        out: list[list] = [[] for _ in range(6)]
        for low, high, length, n, listed, first in repeat_nodes(suffixes, order, copies[context], min_length):
            for column, value in zip(out, (low, high, length, n)):
                column += [value] * len(listed)
            out[4] += listed
            out[5] += [row == first for row in listed]
        rows_out = np.array(out[4], np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(gram[context[rows_out]]),
                *[pa.array(c, pa.int64()) for c in out[:4]],
                pa.array(doc[context[rows_out]]),
                pa.array(start[rows_out]),
                pa.array(out[5], pa.bool_()),
            ],
            ["gram", "low", "high", "length", "n", "_doc", "start", "first"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            if not len(batch):
                continue
            gram = batch.column("gram").to_numpy()
            size = np.cumsum([len(b.as_buffer()) for b in batch.column("body")])
            done, ends = 0, [*(np.flatnonzero(np.diff(gram)) + 1).tolist()]
            # The last bucket may go on in the next batch.
            for end, further in zip(ends, [*ends[1:], None]):
                if further is None or size[further - 1] - (size[done - 1] if done else 0) > _SORTED_BYTES:
                    yield scan([batch.slice(done, end - done)])
                    done = end
            rest = batch.slice(done)
        if rest is not None:
            yield scan([rest])

    return run


# ---- over documents -------------------------------------------------------------------------------------


def _forget(spark: SparkSession) -> None:
    """Files of finished shuffles go when the driver collects its garbage; it is asked to after a step that moved much."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _numbered(docs: DataFrame) -> DataFrame:
    """(_doc, _row, _bytes): rows with a number that orders the documents; equal rows of (doc_id, text) are one document.

    The number is doc_id itself unless some are null or repeated; null ids come last, different texts of one id by their hash.
    """
    own = F.col("doc_id").cast("long")
    octets = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(own.alias("_doc"), set_aside(docs).alias("_row"), F.col("text").alias("_text"), octets.alias("_bytes"))
    ids = docs.select(own.alias("id"))
    if ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").isEmpty():
        return rows
    mark = F.sha2("_bytes", 256).alias("_mark")
    known = rows.select(F.col("_doc").alias("_id"), mark).distinct()
    numbers = number_rows(known, [F.asc_nulls_last("_id"), F.asc("_mark")], "_number")
    marked = rows.withColumn("_sha", F.sha2("_bytes", 256))
    joined = marked.join(numbers, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_mark")))
    return joined.select(F.col("_number").alias("_doc"), "_row", "_text", "_bytes")


def _sliced(min_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The contexts that are wanted of each text: their bytes, or hashes of the strings in them if their bucket is too large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, wanted in zip(*(batch.column(c) for c in ("_doc", "_bytes", "wanted"))):
                body, doc = text.as_buffer(), doc.as_py()
                view, out = memoryview(body), [[], [], [], [], []]
                for entry in wanted.as_py():
                    start, count = entry["place"] >> _COUNT_BITS, entry["place"] & ((1 << _COUNT_BITS) - 1)
                    if not entry["large"]:
                        row = [(entry["gram"], 0, entry["place"], entry["copies"], bytes(view[start : start + count + min_length - 1]))]
                    else:
                        row = []
                        for at in range(start, start + count):
                            piece = view[at : at + min_length]
                            marks = (int.from_bytes(xxhash.xxh64_digest(piece, k), "big", signed=True) for k in (1, 2))
                            row.append((*marks, at << _COUNT_BITS | 1, entry["copies"], None))
                    for column, values in zip(out, zip(*row)):
                        column += values
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(out, types)]
                docs = pa.array([doc] * len(out[0]), pa.int64())
                yield pa.RecordBatch.from_arrays([docs, *columns], ["_doc", "gram", "mark", "place", "copies", "body"])

    return run


def _span(min_length: int) -> list[Column]:
    start = F.shiftright("place", _COUNT_BITS)
    count = F.col("place").bitwiseAND((1 << _COUNT_BITS) - 1)
    return [start.alias("start"), (start + count + (min_length - 1)).alias("end")]


def _gathered(
    numbered: DataFrame, min_length: int, bucket_contexts: int
) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Spans of contexts and strings that occur before, the nodes of the interval trees, and the files that such tables get."""
    spark = numbered.sparkSession
    texts = numbered.select("_doc", "_bytes")
    size = texts.agg(F.sum(F.octet_length("_bytes"))).first()[0] or 0
    files = max(1, -(-size // _TASK_BYTES))
    grams = texts.mapInArrow(_all_contexts(min_length, whole=False), "gram long")
    repeated = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    repeated = written(repeated, "repeated-anchors", files)
    _forget(spark)
    schema = "gram long, mark long, _doc long, place long"
    contexts = texts.mapInArrow(_all_contexts(min_length, whole=True), schema).join(repeated, "gram")
    contexts = written(contexts, "contexts", files)
    _forget(spark)

    # Equal contexts: all but the first are repeats throughout.
    first = F.min(F.struct("_doc", "place")).alias("first")
    classes = contexts.groupBy("gram", "mark").agg(first, F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "context-classes", files)
    several = classes.where("copies > 1").select("gram", "mark", "first")
    others = contexts.join(several, ["gram", "mark"]).where(
        (F.col("_doc") != F.col("first._doc")) | (F.col("place") != F.col("first.place"))
    )
    equal = written(others.select("_doc", *_span(min_length)), "equal-contexts", files)
    drop_written(contexts)
    _forget(spark)

    # The first ones of unlike contexts with one anchor are sorted.
    buckets = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("different")).where("different > 1")
    wanted = classes.join(buckets, "gram").select(
        F.col("first._doc").alias("_doc"), "gram", F.col("first.place").alias("place"), "copies",
        (F.col("different") > bucket_contexts).alias("large"),
    )
    by_doc = wanted.groupBy("_doc").agg(F.collect_list(F.struct("gram", "place", "copies", "large")).alias("wanted"))
    by_doc = written(by_doc, "wanted-contexts", files)
    # Equal rows are one document, which is wanted once.
    once = texts if texts.select("_doc").distinct().count() == texts.count() else texts.dropDuplicates(["_doc"])
    sliced = once.join(by_doc.hint("merge"), "_doc").mapInArrow(
        _sliced(min_length), "_doc long, gram long, mark long, place long, copies long, body binary"
    )
    sliced = written(sliced, "context-texts", files)
    _forget(spark)
    bodies = sliced.where(F.col("body").isNotNull()).select("gram", "_doc", "place", "copies", "body")
    nodes = bodies.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        _scanned(min_length),
        "gram long, low long, high long, length long, n long, _doc long, start long, first boolean",
    )
    nodes = written(nodes, "repeat-nodes", files)
    # Refined buckets hold equal strings only: one node each, if there are two or more.
    strings = sliced.where(F.col("body").isNull()).select("gram", "mark", "_doc", "place", "copies")
    refined = strings.groupBy("gram", "mark").agg(first, F.count(F.lit(1)).alias("different"), F.sum("copies").alias("n"))
    refined = written(refined.where("different > 1").select("gram", "mark", "first", "n"), "refined-buckets", files)
    return equal, nodes, strings.join(refined, ["gram", "mark"]), files


def repeat_groups(
    docs: DataFrame, min_length: int = MIN_LENGTH, bucket_contexts: int = BUCKET_CONTEXTS
) -> DataFrame:
    """The maximal repeats of ``min_length`` bytes or more in the texts of ``docs`` (doc_id, text, …), in pieces by anchor.

    One row per listed occurrence: ``anchor``, ``low`` and ``high`` (the interval; one inside another is a longer repeat),
    ``length``, ``n`` (occurrences, equal contexts included), ``document``, ``start`` and ``first`` (whether none is before it).
    A node lists the first occurrence of each node inside it, whose rows are the others. ``document`` is doc_id, or
    a number in its order if ids are null or repeated. Equal contexts stand for each other: their first is listed.
    """
    _, nodes, refined, _ = _gathered(_numbered(docs), min_length, bucket_contexts)
    start = F.shiftright("place", _COUNT_BITS)
    before = (F.col("_doc") == F.col("first._doc")) & (F.col("place") == F.col("first.place"))
    zero = F.lit(0).cast("long")
    strings = refined.select(
        F.xxhash64("gram", "mark").alias("gram"), zero.alias("low"), zero.alias("high"), F.lit(min_length).cast("long").alias("length"),
        "n", "_doc", start.alias("start"), before.alias("first"),
    )
    return nodes.unionByName(strings).withColumnsRenamed({"gram": "anchor", "_doc": "document"})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (_row, _text, _bytes, _spans): the bytes outside of all spans, and how many are in how many runs."""
    for batch in batches:
        kept, removed, runs = [], [], []
        for text, spans in zip(batch.column("_bytes"), batch.column("_spans")):
            if not spans.is_valid:
                kept.append(text.as_py())
                removed.append(0)
                runs.append(0)
                continue
            flat = spans.values.flatten()
            starts, ends = (x.to_numpy() for x in flat)
            order = np.argsort(starts, kind="stable")
            starts, reach = starts[order], np.maximum.accumulate(ends[order])
            new = np.concatenate(([True], starts[1:] > reach[:-1]))
            lows = starts[new]
            highs = reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
            view, at, parts = memoryview(text.as_buffer()), 0, []
            for low, high in zip(lows.tolist(), highs.tolist()):
                parts.append(view[at:low])
                at = high
            parts.append(view[at:])
            kept.append(b"".join(parts))
            removed.append(int((highs - lows).sum()))
            runs.append(len(lows))
        sizes = [len(t.as_buffer()) for t in batch.column("_bytes")]
        added = [pa.array(c, pa.int64()) for c in (sizes, removed, runs)]
        columns = [batch.column("_row"), batch.column("_text"), pa.array(kept, pa.binary()), *added]
        yield pa.RecordBatch.from_arrays(columns, ["_row", "_text", "kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeats(
    docs: DataFrame, min_length: int = MIN_LENGTH, bucket_contexts: int = BUCKET_CONTEXTS
) -> DataFrame:
    """``docs`` (doc_id, text, …) with what is left of each text without repeats of ``min_length`` bytes, and three counts.

    A byte goes if a string of ``min_length`` bytes that covers it also starts earlier: in a document with a smaller doc_id,
    or farther up in the same one; strings may overlap. Adds ``kept`` (bytes, as UTF-8 sequences can be cut), ``n_bytes``,
    ``n_removed`` and ``n_spans`` (runs of removed bytes); columns of these names are replaced. A null text is empty.
    Rows equal in doc_id and text are one document and get the same result; rows without doc_id come after all
    others. Texts shorter than ``min_length`` stay whole. No rows give none.
    """
    added = ["kept", "n_bytes", "n_removed", "n_spans"]
    own = docs.drop(*added)
    numbered = _numbered(own)
    equal, nodes, refined, files = _gathered(numbered, min_length, bucket_contexts)
    end = (F.col("start") + F.col("length")).alias("end")
    again = (F.col("_doc") != F.col("first._doc")) | (F.col("place") != F.col("first.place"))
    spans = equal.unionByName(nodes.where(~F.col("first")).select("_doc", "start", end))
    spans = spans.unionByName(refined.where(again).select("_doc", *_span(min_length)))
    by_doc = spans.groupBy("_doc").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    by_doc = written(by_doc, "repeat-spans", files)
    _forget(docs.sparkSession)
    joined = numbered.join(by_doc.hint("merge"), "_doc", "left").select("_row", "_text", "_bytes", "_spans")
    row, text = joined.schema["_row"].dataType.simpleString(), joined.schema["_text"].dataType.simpleString()
    cut = joined.mapInArrow(_cut, f"_row {row}, _text {text}, kept binary, n_bytes long, n_removed long, n_spans long")
    return cut.select(*put_back(own.columns, "_row", "_text"), *added)
