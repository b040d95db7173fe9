"""Joins of a large table to a one-row-per-key table when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.plans.workspace import written

# A lookup side is broadcast only after it was measured and found to have at most so many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20
# Keys that are spread. No other key can hold more than 1 / (HOT_KEYS + 1) of the rows.
HOT_KEYS = 1000
# Parts each frequent key is spread over; the lookup grows by at most HOT_KEYS * SALTS rows.
SALTS = 256


def fits_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a lookup is small enough to broadcast, by its rows and the bytes of its values."""
    width = F.lit(0).cast("long")
    for f in lookup.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + 16 + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = width + 16 + 16 * F.coalesce(F.size(f"`{f.name}`"), F.lit(0))
        else:
            width = width + 16
    size = lookup.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= BROADCAST_BYTES


def frequent_keys(rows: DataFrame, key: str, n: int = HOT_KEYS) -> DataFrame:
    """The ``n`` most frequent keys, as a stored table."""
    return _most_frequent(_counted(rows, key), key, n)


def _counted(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def _most_frequent(counted: DataFrame, key: str, n: int = HOT_KEYS) -> DataFrame:
    return written(counted.orderBy(F.desc("_n"), key).limit(n).select(key), "frequent-keys")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    frequent: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left or inner join of ``rows`` to ``lookup`` (at most one row per key).

    A lookup that was counted to fit is broadcast, and so is the part of it that ``rows`` ask for. Otherwise the rows of the most frequent keys, and those
    without a key, are spread over ``SALTS`` parts by a hash of the whole row, and the lookup rows of these
    keys are repeated for every part; all other keys are rare. ``frequent`` are the frequent keys if the
    caller can tell them; they are counted in ``rows`` otherwise, which is then written first so that it is
    computed once.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    if fits_broadcast(lookup, max_rows):
        return rows.join(F.broadcast(lookup), key, how)
    if frequent is None:
        rows = written(rows, "lookup-rows")
        keys = written(_counted(rows, key), "lookup-keys")
        if keys.count() <= max_rows:
            asked = written(lookup.join(keys.select(key), key, "left_semi"), "lookup-asked")
            if fits_broadcast(asked, max_rows):
                return rows.join(F.broadcast(asked), key, how)
        frequent = _most_frequent(keys, key)
    hot = F.broadcast(frequent.withColumn("_hot", F.lit(True)))
    spread = F.col("_hot").isNotNull() | F.col(key).isNull()
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = rows.join(hot, key, "left").withColumn("_part", F.when(spread, part).otherwise(0)).drop("_hot")
    repeated = lookup.join(hot, key, "left").withColumn("_part", F.explode(parts)).drop("_hot")
    return salted.join(repeated, [key, "_part"], how).drop("_part")
