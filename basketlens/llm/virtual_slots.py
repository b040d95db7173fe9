"""Sharding over fixed virtual slots, in DataFrame functions only.

Records are hashed into a fixed number of slots. The bytes of each slot are summed, and a map of slots to
shards is made from these sums; it is stored as a table with a version. Rebalancing edits the map: a few slots
move, everything else stays where it is. What the driver sees is the map, one number per slot, never a record.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.plans.workspace import written

SLOTS = 8192
# Bytes that a record takes beside its text.
RECORD_BYTES = 16
# Records that one numbering group should hold on average.
GROUP_ROWS = 50_000


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (none for null) plus RECORD_BYTES."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def with_slots(docs: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, _hash) of every row of ``docs`` (doc_id, text, …)."""
    rows = docs.select(
        "doc_id",
        record_size().alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("_hash"),
    )
    return rows.withColumn("virtual_slot", F.pmod("_hash", F.lit(n_slots)).cast("int"))


def with_slots_apart(docs: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """:func:`with_slots`, stored, with equal rows spread over the slots.

    Rows that repeat another in doc_id and text are hashed once more, with their place in the stored table. A key that many
    rows share so neither fills a slot nor a task.
    """
    stored = written(with_slots(docs, n_slots).withColumn("_place", F.monotonically_increasing_id()), "slotted")
    again = stored.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(again.select("_hash", F.lit(True).alias("_again")), "repeated-rows")
    if again.isEmpty():
        return stored.drop("_place")
    apart = F.when(F.col("_again"), F.xxhash64("_hash", "_place")).otherwise(F.col("_hash"))
    spread = stored.join(again, "_hash", "left").withColumn("_hash", apart).drop("_again", "_place")
    return written(spread.withColumn("virtual_slot", F.pmod("_hash", F.lit(n_slots)).cast("int")), "slotted")


def slot_bytes(slotted: DataFrame, n_slots: int) -> list[int]:
    """Bytes per slot; ``n_slots`` numbers, whatever the input."""
    sums = [0] * n_slots
    for row in slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).toLocalIterator():
        sums[row["virtual_slot"]] = int(row["bytes"])
    return sums


def first_map(sizes: list[int], n_shards: int) -> list[int]:
    """Shard of each slot: slots from the largest on, each into the shard that is lightest then."""
    loads = [(0, shard) for shard in range(n_shards)]
    shards = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        load, shard = heapq.heappop(loads)
        shards[slot] = shard
        heapq.heappush(loads, (load + sizes[slot], shard))
    return shards


def rebalanced(shards: list[int], sizes: list[int], n_shards: int, tolerance: float = 0.01) -> list[int]:
    """The map edited for new sizes or more shards: slots move one by one from the heaviest to the lightest shard.

    Ends when the heaviest is within ``tolerance`` of the mean, or no move lowers it. A shard at or above
    ``n_shards`` is emptied. Slots that need not move stay.
    """
    if n_shards < 1:
        raise ValueError("a map needs at least one shard")
    edited, held = list(shards), [[] for _ in range(max(n_shards, max(shards, default=0) + 1))]
    loads = [0] * len(held)
    for slot in sorted(range(len(sizes)), key=lambda s: (sizes[s], s)):
        held[shards[slot]].append(slot)
        loads[shards[slot]] += sizes[slot]

    def move(slot: int, to: int) -> None:
        held[edited[slot]].remove(slot)
        loads[edited[slot]] -= sizes[slot]
        edited[slot] = to
        loads[to] += sizes[slot]
        held[to].append(slot)

    for shard in range(n_shards, len(held)):
        for slot in reversed(held[shard][:]):
            move(slot, min(range(n_shards), key=loads.__getitem__))
    mean = sum(sizes) / n_shards
    while True:
        heavy = max(range(n_shards), key=loads.__getitem__)
        light = min(range(n_shards), key=loads.__getitem__)
        gap = loads[heavy] - loads[light]
        # The largest slot that leaves both below the heavy shard's load.
        fits = [s for s in held[heavy] if 0 < sizes[s] < gap]
        if loads[heavy] <= mean * (1 + tolerance) or not fits:
            return edited
        half = [s for s in fits if 2 * sizes[s] <= gap]
        move(max(half or fits, key=lambda s: (sizes[s] if half else -sizes[s], -s)), light)


def store_map(spark: SparkSession, path: str, version: int, shards: list[int], sizes: list[int]) -> None:
    """Add a version of the map to the table at ``path``: (version, virtual_slot, shard, bytes)."""
    written_as = F.from_json(F.lit(json.dumps([[a, b] for a, b in zip(shards, sizes)])), "array<array<long>>")
    if version in map_versions(spark, path):
        raise ValueError(f"the map at {path} has a version {version} already")
    rows = spark.range(1).select(F.posexplode(written_as).alias("virtual_slot", "entry"))
    rows = rows.select(
        F.lit(version).alias("version"),
        "virtual_slot",
        F.get("entry", F.lit(0)).cast("int").alias("shard"),
        F.get("entry", F.lit(1)).alias("bytes"),
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def map_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions stored at ``path``, none if nothing is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return []
    return sorted(r["version"] for r in spark.read.parquet(path).select("version").distinct().collect())


def read_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int], list[int]]:
    """(version, shard of each slot, bytes of each slot) of a version, the latest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).orderBy("virtual_slot").collect()
    return version, [r["shard"] for r in rows], [r["bytes"] for r in rows]


def assign(slotted: DataFrame, shards: list[int]) -> DataFrame:
    """``slotted`` with its shard, by the map as an array literal."""
    listed = F.from_json(F.lit(json.dumps(shards)), "array<int>")
    return slotted.withColumn("shard", F.get(listed, F.col("virtual_slot")))


def number_in_shards(assigned: DataFrame, name: str = "slot") -> DataFrame:
    """Add ``name``: 0, 1, 2, … within each shard, by virtual slot.

    Slots are cut into as many groups as keep a group near GROUP_ROWS records; each group is numbered on its
    own, and starts where the groups before it in its shard end. Which of several equal rows gets which of their
    numbers is open.
    """
    total = assigned.count()
    n_slots = max(1, assigned.agg(F.max("virtual_slot")).first()[0] or 0) + 1
    cuts = max(1, -(-total // (n_slots * GROUP_ROWS)))
    cut = F.pmod(F.shiftright("_hash", 20), F.lit(cuts)).cast("int")
    grouped = assigned.withColumn("_cut", cut)
    counts = grouped.groupBy("shard", "virtual_slot", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "virtual_slot", "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("virtual_slot", "_cut").orderBy("_hash", "doc_id")
    numbered = grouped.withColumn("_place", F.row_number().over(within) - 1)
    joined = numbered.join(starts, ["virtual_slot", "_cut"])
    return joined.withColumn(name, (F.col("_start") + F.col("_place")).cast("long")).drop("_cut", "_start", "_place")


def shard_documents(docs: DataFrame, n_shards: int, path: str, n_slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, slot) for every row of ``docs`` (doc_id, text, …).

    Stores version 1 of the map at ``path``, or, if there is a map already, its next version, edited for the new sizes, and
    assigns by what is stored. Rows equal in doc_id and text are spread like others; null ids and null texts are values like
    others, and a null text has checksum 0 and no bytes of its own. Other columns are not read. No rows give none, and a map all the same.
    """
    spark = docs.sparkSession
    slotted = with_slots_apart(docs, n_slots)
    sizes = slot_bytes(slotted, n_slots)
    if known := map_versions(spark, path):
        _, before, _ = read_map(spark, path)
        if len(before) != n_slots:
            raise ValueError(f"the map at {path} has {len(before)} slots")
        store_map(spark, path, known[-1] + 1, rebalanced(before, sizes, n_shards), sizes)
    else:
        store_map(spark, path, 1, first_map(sizes, n_shards), sizes)
    _, shards, _ = read_map(spark, path)
    return number_in_shards(assign(slotted, shards)).drop("_hash")
