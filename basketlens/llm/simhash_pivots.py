"""SimHash near-duplicates, with pivot distance tables to discard pairs.

A fingerprint has 64 bits; a bit is set if it is set in over half of the document's shingle hashes. Equal
fingerprints are one class, so copies cost one row. For every class the Hamming distances to 16 reference
fingerprints are computed once and carried along. Two fingerprints whose distance to any reference differs by
more than the limit cannot lie within the limit, so their pair is discarded; survivors are verified.

Which pairs are looked at: the 64 bits are cut into ``limit + 6`` blocks. Fingerprints within ``limit`` bits agree
on all but ``limit`` blocks, so they meet under at least one key made of six whole blocks; with 2 bits that
is 28 keys per class and at most 2^16 classes per key, whatever the data. Within a key the rows lie sorted by
their first table column and are compared with those whose column is near. A task emits links to one
representative per group, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import connected_components, local_roots, put_back, set_aside
from basketlens.plans.workspace import written

SEED = 42
BITS = 64
# Reference fingerprints; their distances fill two 64-bit words, one byte each.
PIVOTS = 16
KEY_BLOCKS = 6
# Shingle hashes whose bits are unpacked at a time.
_SLICE = 65_536


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of one UTF-8 text; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    tails = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), tails.tolist())], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _SLICE):
        octets = hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], ["doc_id", "fp"])

    return run


def simhash(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): A-Z lower-cased, words split at ASCII white space, ``shingle`` words joined by a space,
    hashed with XXH64. Fewer words than that are one shingle; no words or a null text give 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def _pivot(i: int) -> int:
    return xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table() -> list:
    """Two columns; byte j of column i is the distance to reference fingerprint 8 i + j."""
    words = []
    for i in range(PIVOTS // 8):
        word = F.lit(0).cast("long")
        for j in range(8):
            far = F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(_pivot(8 * i + j))))).cast("long")
            word = word.bitwiseOR(F.shiftleft(far, 8 * j))
        words.append(word.alias(f"table{i}"))
    return words


def _masks(limit: int) -> list[int]:
    """The bits of each key: all choices of KEY_BLOCKS of the blocks."""
    n = limit + KEY_BLOCKS
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(blocks, KEY_BLOCKS)]


def _linked(key: np.ndarray, fp: np.ndarray, table: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the verified pairs among rows sorted by key and first table column."""
    near = table[:, 0].astype(np.int16)
    at, step, left, right = np.arange(len(key)), 1, [], []
    while True:
        at = at[at + step < len(key)]
        other = at + step
        # The first column only grows along a key, so a row that has left this window is done.
        go = (key[at] == key[other]) & (near[other] - near[at] <= limit)
        at, other = at[go], other[go]
        if not len(at):
            break
        gap = np.abs(table[at].astype(np.int16) - table[other].astype(np.int16)).max(axis=1)
        a, b = at[gap <= limit], other[gap <= limit]
        true = np.bitwise_count(fp[a] ^ fp[b]) <= limit
        left.append(a[true])
        right.append(b[true])
        step += 1
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _compare(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, fp, table0, table1, rep) come sorted by key; a key may go on in the next batch."""

    def links(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        table = np.stack([rows["table0"], rows["table1"]], axis=1).view(np.uint8).reshape(-1, PIVOTS)
        order = np.lexsort((table[:, 0], rows["key"]))
        fp, rep = rows["fp"][order].view(np.uint64), rows["rep"][order]
        a, b = _linked(rows["key"][order], fp, table[order], limit)
        root = rep[local_roots(len(rep), a, b)]
        out = rep != root
        return pa.RecordBatch.from_arrays([pa.array(rep[out]), pa.array(root[out])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] | None = None
        for batch in batches:
            rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
            if kept:
                rows = {n: np.concatenate([kept[n], rows[n]]) for n in rows}
            if not len(rows["key"]):
                continue
            last = np.searchsorted(rows["key"], rows["key"][-1])
            kept = {n: x[last:] for n, x in rows.items()}
            if last:
                yield links({n: x[:last] for n, x in rows.items()})
        if kept:
            yield links(kept)

    return run


def fingerprint_components(fingerprints: DataFrame, limit: int = 2) -> DataFrame:
    """(fp, component_id): one row per distinct fingerprint, over links at ``limit`` or fewer differing bits.

    ``component_id`` is the smallest doc_id reachable; null if no document of the fingerprint has an id.
    """
    classes = written(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    keys = F.array(
        *[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(_masks(limit))]
    )
    tables = classes.where(F.col("rep").isNotNull()).select("fp", *pivot_table(), "rep")
    rows = tables.select(F.explode(keys).alias("key"), "fp", "table0", "table1", "rep")
    edges = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(limit), "a long, b long")
    members = connected_components(edges, "a", "b")
    joined = classes.join(members, classes["rep"] == members["node"], "left")
    return joined.select("fp", F.coalesce("component", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text, …).

    Documents without words (null, empty, white space) share fingerprint 0 and are linked like any other.
    Repeated rows each get a row. A row without doc_id gets its fingerprint and the component of that
    fingerprint, which is null if only such rows have it. Other columns are not read. No rows give none.
    """
    marks = written(simhash(docs, shingle), "fingerprints")
    groups = written(fingerprint_components(marks, limit), "groups")
    return marks.join(groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """Documents of ``docs`` that are the smallest doc_id of their group, with all columns.

    Rows that repeat such a doc_id are the same document and stay; rows without doc_id cannot be told apart
    from each other and stay as well.
    """
    found = near_duplicates(docs, shingle, limit)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    whole = docs.join(kept, docs["doc_id"].cast("long") == kept["_kept"], "left_semi")
    return whole.unionByName(docs.where(F.col("doc_id").isNull()))


def keep_single(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """One row of each group of ``docs`` (doc_id, text, …), with all columns.

    It has the smallest doc_id of the group; of rows that share it, the one with the smallest hash of its columns.
    Rows without doc_id take part with a number made of their text, above 2^62; they are kept only if none of their
    group has a smaller doc_id.
    """
    made = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    keyed = docs.select(
        set_aside(docs).alias("_row"), "text", F.coalesce(F.col("doc_id").cast("long"), made).alias("doc_id"),
        F.xxhash64(*hashed).alias("_mark"),
    )
    found = near_duplicates(keyed, shingle, limit)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    copies = keyed.groupBy("doc_id", "_mark").agg(F.count(F.lit(1)).alias("n"))
    first = copies.groupBy("doc_id").agg(F.min(F.struct("_mark", "n")).alias("first"))
    chosen = written(kept.join(first, "doc_id").select("doc_id", "first._mark", "first.n"), "kept")
    once = keyed.join(chosen.where("n = 1"), ["doc_id", "_mark"], "left_semi")
    if not (again := chosen.where("n > 1")).isEmpty():
        equal = keyed.join(again, ["doc_id", "_mark"], "left_semi")
        once = once.unionByName(equal.dropDuplicates(["doc_id", "_mark"]))
    return once.select(*put_back(docs.columns, "_row"))
