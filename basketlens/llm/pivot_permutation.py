"""Near-duplicate embeddings by a pivot-permutation index.

Each vector is described by its nearest reference points, in order. An inverted list per set of ``shared``
reference points holds the vectors that have all of these among their nearest; vectors that meet in a list share at
least that many, and are verified by cosine. A pair that meets in several lists is verified in the first only.

Reference points are random directions from a fixed seed, so nothing is fitted and every vector is indexed. Equal
vectors are one class. A list longer than ``BLOCK_ROWS`` is cut into blocks that are compared two by two. A
task emits numbers of links per vector and links to one representative, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import connected_components, local_roots
from basketlens.plans.workspace import written

PIVOTS = 1024
NEAREST = 8
SHARED = 3
THRESHOLD = 0.95
BLOCK_ROWS = 2048
_SEED = 20_240_229
# More than any number of reference points; the members of a subset are digits to this base.
PIVOTS_BASE = 1 << 16
# Names of vectors without an id begin here.
MADE_IDS = 1 << 62
# Vectors described in one matrix product, and rows of a list compared with the others at a time.
_BATCH = 2048
_STRIP = 512
# Columns that tell a list and its two blocks, and numbers of its rows.
_LIST = ["dimension", "subset", "i", "j"]
_NUMBERS = ["subset", "i", "j", "side", "rep", "mark", "copies"]


@cache
def pivots(dimension: int, n: int = PIVOTS) -> np.ndarray:
    """``n`` unit vectors of this dimension, always the same."""
    points = np.random.default_rng([_SEED, dimension]).standard_normal((n, dimension))
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as doubles in bytes; null for those that link with nothing."""
    for batch in batches:
        out = []
        for value in batch.column(1):
            numbers = value.values
            if numbers is None or len(numbers) == 0 or numbers.null_count:
                out.append(None)
                continue
            x = numbers.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vec"])


def nearest_pivots(vectors: np.ndarray, n_pivots: int, nearest: int) -> np.ndarray:
    """The ``nearest`` reference points of each unit vector, nearest first."""
    near = vectors @ pivots(vectors.shape[1], n_pivots).T
    top = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
    order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
    return np.take_along_axis(top, order, 1).astype(np.int32)


def _describe(n_pivots: int, nearest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vec").to_pylist()
            sizes = np.array([len(v) for v in raw])
            near = np.zeros((len(raw), nearest), np.int32)
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                for start in range(0, len(same), _BATCH):
                    rows = same[start : start + _BATCH]
                    vectors = _unit(np.stack([np.frombuffer(raw[i], "<f8") for i in rows]))
                    near[rows] = nearest_pivots(vectors, n_pivots, nearest)
            described = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), nearest).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, described], [*batch.schema.names, "near"])

    return run


def _subset_columns(nearest: int, shared: int) -> Column:
    """All subsets of the nearest points, each as one number over its sorted members."""
    members = F.array_sort("near")
    codes = []
    for chosen in combinations(range(nearest), shared):
        code = F.lit(0).cast("long")
        for c in chosen:
            code = code * PIVOTS_BASE + F.get(members, F.lit(c))
        codes.append(code)
    return F.array(*codes)


def _meets_first(near: np.ndarray, last: int) -> np.ndarray:
    """Presence rows over the reference points up to ``last``, the largest that names the list. The product of two rows
    is the number of these points that both have; it is the size of the name if the list is the pair's first."""
    points, place = np.unique(near, return_inverse=True)
    present = np.zeros((len(near), len(points)), np.float32)
    np.put_along_axis(present, place.reshape(near.shape), 1, axis=1)
    return present[:, points <= last]


def _links(
    vectors: np.ndarray, near: np.ndarray, last: int, shared: int, threshold: float, side: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (a < b) of one list that are as near as ``threshold`` and meet nowhere before; with ``side`` only
    those of different sides."""
    left, right, present = [], [], None
    for start in range(0, len(vectors), _STRIP):
        # A strip against itself and the rows after it.
        cosine = vectors[start : start + _STRIP] @ vectors[start:].T
        a, b = np.nonzero(cosine >= threshold - 1e-12)
        a, b = a[a < b], b[a < b]
        if not len(a):
            continue
        if present is None:
            present = _meets_first(near, last)
        go = (present[start : start + _STRIP] @ present[start:].T)[a, b] == shared
        # The order of sums in a product is open; next to the threshold they are taken in one order.
        close = np.flatnonzero(go & (np.abs(cosine[a, b] - threshold) <= 1e-12))
        go[close] = [vectors[start + i].dot(vectors[start + j]) >= threshold for i, j in zip(a[close], b[close])]
        a, b = a[go] + start, b[go] + start
        if side is not None:
            a, b = a[side[a] != side[b]], b[side[a] != side[b]]
        left.append(a)
        right.append(b)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _verify(
    shared: int, threshold: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by list and block pair; a list may go on in the next batch."""

    def links(rows: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        """Links of the lists that begin at ``starts`` and end where the next one, or the last entry, begins."""
        subset, i, j, side, rep, mark, copies = (rows.column(c).to_numpy() for c in _NUMBERS)
        packed = rows.column("vec").cast(pa.large_binary())
        ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
        data = np.frombuffer(packed.buffers()[2], np.uint8)
        near = rows.column("near").flatten().to_numpy().reshape(rows.num_rows, -1)
        out: list[list] = [[], [], [], []]
        for at, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            n = end - at
            vectors = _unit(data[ends[at] : ends[end]].view("<f8").reshape(n, -1))
            last = int(subset[at]) % PIVOTS_BASE
            sides = side[at:end] if i[at] != j[at] else None
            a, b = _links(vectors, near[at:end], last, shared, threshold, sides)
            if not len(a):
                continue
            counts = np.zeros(n, np.int64)
            np.add.at(counts, a, copies[at + b])
            np.add.at(counts, b, copies[at + a])
            found = np.flatnonzero(counts)
            root = local_roots(n, a, b)[found]
            for column, values in zip(out, (rep[at + found], mark[at + found], counts[found], rep[at + root])):
                column += values.tolist()
        return _batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _LIST])
            starts = np.concatenate(([0], 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))))
            yield links(batch, starts)
            held = batch.slice(starts[-1])
        if held is not None:
            yield links(held, np.array([0, held.num_rows]))

    return run


def _batch(out: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["rep", "mark", "n", "root"])


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    n_pivots: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding, …).

    Two vectors are linked when their cosine is ``threshold`` or more. ``component_id`` is the smallest vec_id
    reachable (ids are below 2^62), ``kept`` whether that is the vector itself. Vectors that are null, empty, zero or hold null or non-finite
    components have no links. Vectors of different dimension are never compared. Rows that repeat a
    vec_id are vectors of their own and share a component; a row without vec_id counts as a link of
    others and has component null and is not kept. Other columns are not read.
    """
    if n_pivots >= PIVOTS_BASE or shared > 3:
        raise ValueError("a list is named by at most three of fewer than 65,536 reference points")
    source = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    vectors = written(source.mapInArrow(_clean, "vec_id long, vec binary"), "vectors")
    usable = vectors.where(F.col("vec").isNotNull())
    classes = usable.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # A class without any vec_id still is a link of others; it is named by its vector, above all ids.
    made = F.xxhash64("vec").bitwiseAND(F.lit(MADE_IDS - 1)).bitwiseOR(F.lit(MADE_IDS))
    # A repeated vec_id can stand for several classes; its hash tells them apart.
    classes = classes.select(F.coalesce("rep", made).alias("rep"), F.xxhash64("vec").alias("mark"), "copies", "vec")
    schema = "rep long, mark long, copies long, vec binary, near array<int>"
    described = classes.mapInArrow(_describe(n_pivots, nearest), schema)
    described = written(described, "vector-classes")

    dimension = (F.octet_length("vec") / 8).cast("int").alias("dimension")
    lists = described.select(dimension, F.explode(_subset_columns(nearest, shared)).alias("subset"), "rep", "mark")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    several = lists.groupBy("dimension", "subset").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = written(several.select("dimension", "subset", blocks.alias("blocks")), "shared-lists")
    side = F.pmod(F.xxhash64("rep", "mark"), F.col("blocks")).cast("int")
    met = lists.join(several, ["dimension", "subset"]).withColumn("side", side)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")
    met = written(met.select("dimension", "subset", i, j, "side", "rep", "mark"), "list-members")

    rows = met.join(described, ["rep", "mark"]).select(*_LIST, "side", "rep", "mark", "copies", "vec", "near")
    found = rows.repartition(*_LIST).sortWithinPartitions(*_LIST).mapInArrow(
        _verify(shared, threshold), "rep long, mark long, n long, root long"
    )
    found = written(found, "vector-links")
    members = connected_components(found, "rep", "root").withColumnRenamed("node", "rep")
    linked = found.groupBy("rep", "mark").agg(F.sum("n").alias("n"))
    told = described.select("rep", "mark", "copies", "vec").join(linked, ["rep", "mark"], "left").join(members, "rep", "left")
    n_links = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    told = written(told.select("vec", n_links, F.coalesce("component", "rep").alias("component_id")), "vector-groups")
    joined = vectors.join(told, "vec", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
