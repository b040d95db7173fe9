"""Implicit-feedback ALS as candidate generator."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator, inheritable_thread_target
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.operators.als_solver import Factors, RatingBlocks
from basketlens.plans.numbering import number_rows
from basketlens.plans.skew import fits_broadcast, frequent_keys, lookup_join
from basketlens.plans.workspace import released_shuffles, shared_dir, written

# Item factors are broadcast in blocks of at most this many 32-bit numbers (64 MB).
BLOCK_FACTORS = 16_000_000
# Article ids are broadcast in blocks of at most so many bytes.
BLOCK_NAMES = 64 << 20
# Articles whose scores are bounded together, scores held at a time by a task, and customers for which it fetches the blocks.
SLICE_ITEMS = 4096
_SCORES_PER_STEP = 2_000_000
_CUSTOMERS_PER_PASS = 10_000
# Fewer customers are not worth a task of their own.
_CUSTOMERS_PER_TASK = 256
# Exact scores that are taken at a time.
_PAIRS_PER_STEP = 65_536
# A box whose far corner has so many times the median norm in it tells less than the norm.
_LOOSE_BOX = 2.0
# Threads of a grid bring their blocks through the driver one after the other.
_one_block = threading.Lock()


def id_index(ids: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """Distinct ids in sorted order, numbered from 0."""
    distinct = ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    numbered = number_rows(distinct, [F.col(id_col)], index_col)
    return numbered.withColumn(index_col, F.col(index_col).cast("int"))


def user_item_counts(train: DataFrame) -> DataFrame:
    counts = train.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("purchase_count"))
    return counts.filter(F.col("customer_id").isNotNull() & F.col("article_id").isNotNull())


def indexed_counts(counts: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Purchase counts keyed by the integer indices; ``counts`` should be a stored table.

    Both ids can be hot, so both are lookup joins. The frequent keys are counted in ``counts``.
    """
    joined = counts
    for lookup, key in ((items, "article_id"), (users, "customer_id")):
        small = fits_broadcast(lookup)
        joined = lookup_join(joined, lookup, key, "inner", None if small else frequent_keys(counts, key))
    return joined.select("customer_idx", "article_idx", "purchase_count")


def user_item_confidence(train: DataFrame, alpha: float = S.ALS_ALPHA) -> DataFrame:
    """The confidence matrix as coordinates: 1 + alpha * purchases for every bought pair."""
    counts = written(user_item_counts(train), "als-pairs")
    users = id_index(counts, "customer_id", "customer_idx")
    items = id_index(counts, "article_id", "article_idx")
    return indexed_counts(counts, users, items).select(
        "customer_idx", "article_idx", (1 + alpha * F.col("purchase_count")).cast("float").alias("confidence")
    )


@dataclass
class ALSParams:
    factors: int = S.ALS_FACTORS
    iterations: int = S.ALS_ITERATIONS
    regularization: float = S.ALS_REGULARIZATION
    alpha: float = S.ALS_ALPHA
    seed: int = S.SEED

    def __post_init__(self) -> None:
        if self.factors < 1 or self.iterations < 1:
            raise ValueError("factors and iterations must be at least 1")


@dataclass
class ALSInput:
    """Id maps and purchase counts, stored once for any number of fits."""

    users: DataFrame
    items: DataFrame
    counts: DataFrame
    _blocks: list[RatingBlocks] = field(default_factory=list)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def blocks(self) -> RatingBlocks:
        """The counts as the solver reads them, made once."""
        with self._lock:
            if not self._blocks:
                self._blocks.append(RatingBlocks.of(self.counts, self.users.count(), self.items.count()))
            return self._blocks[0]

    @classmethod
    def of(cls, train: DataFrame, stats: DataFrame | None = None) -> ALSInput:
        """From the training window's rows, or from ``stats`` if they exist already."""
        for col in ("customer_id", "article_id"):
            if col not in train.columns:
                raise ValueError(f"ALS needs the column {col}")
        if stats is None:
            pairs = written(user_item_counts(train), "als-pairs")
        else:
            both = F.col("customer_id").isNotNull() & F.col("article_id").isNotNull()
            pairs = stats.filter(both).select("customer_id", "article_id", "purchase_count")
        if pairs.isEmpty():
            raise ValueError("ALS got an empty table")
        users = written(id_index(pairs, "customer_id", "customer_idx"), "als-users")
        items = written(id_index(pairs, "article_id", "article_idx"), "als-items")
        return cls(users, items, written(indexed_counts(pairs, users, items), "als-counts"))


@dataclass
class ALSCandidates:
    """A fitted factor model with its id maps and training counts, all of them stored tables."""

    params: ALSParams
    model: Factors
    users: DataFrame
    items: DataFrame
    counts: DataFrame
    block_factors: int = BLOCK_FACTORS

    @classmethod
    def fit(cls, train: DataFrame, params: ALSParams | None = None, stats: DataFrame | None = None) -> ALSCandidates:
        """Train on the purchase counts of the training window (``stats`` if they exist already)."""
        shared_dir(train.sparkSession)
        return cls.fit_input(ALSInput.of(train, stats), params)

    @classmethod
    def fit_input(cls, given: ALSInput, params: ALSParams | None = None) -> ALSCandidates:
        params = params or ALSParams()
        # An iteration shuffles every factor to nearly every block; only the last few iterations stay on disk.
        with released_shuffles(given.counts.sparkSession):
            model = given.blocks().fit(params.factors, params.iterations, params.regularization, params.alpha, params.seed)
        return cls(params, model, given.users, given.items, given.counts)

    @property
    def n_users(self) -> int:
        return self.users.count()

    @property
    def n_items(self) -> int:
        return self.items.count()

    def known(self, users: DataFrame) -> DataFrame:
        """The customers of ``users`` that have a factor."""
        return users.select("customer_id").distinct().join(self.users, "customer_id", "left_semi")

    def require_known(self, users: DataFrame) -> None:
        unknown = users.select("customer_id").join(self.users, "customer_id", "left_anti").first()
        if unknown is not None:
            raise KeyError(f"no ALS factor for customer {unknown['customer_id']!r}")

    def recommend(
        self,
        users: DataFrame,
        k: int = S.N_CANDIDATES,
        exclude_seen: bool = True,
        counts: SearchCounts | None = None,
    ) -> DataFrame:
        """Top ``k`` per known customer.

        Returns (customer_id, article_id, als_rank from 0, list_size, model_score). Customers without training
        history have no rows. A list is shorter than ``k`` only when the customer bought all but a few articles.
        Equal scores go by article id.
        """
        wanted = users.select("customer_id").distinct().join(self.users, "customer_id")
        customers = wanted.join(self.model.userFactors.withColumnRenamed("id", "customer_idx"), "customer_idx")
        bought = self.counts if exclude_seen else None
        block_items = max(1, self.block_factors // self.model.rank)
        return rank_candidates(customers, self.model.itemFactors, bought, k, block_items, counts, self.items)

    def save(self, path: str) -> None:
        spark = self.users.sparkSession
        for name in ("userFactors", "itemFactors"):
            getattr(self.model, name).write.mode("overwrite").parquet(f"{path}/model/{name}")
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.items.write.mode("overwrite").parquet(f"{path}/items")
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        params = spark.createDataFrame([(json.dumps(asdict(self.params)),)], "value string")
        params.coalesce(1).write.mode("overwrite").text(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ALSCandidates:
        params = ALSParams(**json.loads(spark.read.text(f"{path}/params").first()[0]))
        tables = [spark.read.parquet(f"{path}/{t}") for t in ("users", "items", "counts")]
        factors = (spark.read.parquet(f"{path}/model/{t}") for t in ("userFactors", "itemFactors"))
        return cls(params, Factors(params.factors, *factors), *tables)


@dataclass
class SearchCounts:
    """How many slices of articles were scored for a customer, and how many were skipped; repeated tasks count again."""

    scored: Accumulator
    skipped: Accumulator

    @classmethod
    def of(cls, spark: SparkSession) -> SearchCounts:
        return cls(spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0))

    @property
    def skipped_share(self) -> float:
        return self.skipped.value / max(1, self.scored.value + self.skipped.value)


@dataclass
class Slice:
    """Some articles in the order of their indices, the largest norm among them, and the box that holds their factors."""

    ids: np.ndarray
    factors: np.ndarray
    norm: float
    low: np.ndarray
    high: np.ndarray


def norm_slices(ids: np.ndarray, factors: np.ndarray, size: int) -> list[Slice]:
    """Articles cut into slices of like factors, by falling norms, then first ids.

    Articles are halved until a slice has at most ``size``: by the widest of their factors if their box tells more than their
    norms, else by norm, equal ones by index.
    """
    norms = np.linalg.norm(factors.astype(np.float64), axis=1)
    slices, open_parts = [], [np.argsort(ids, kind="stable")]
    while open_parts:
        part = open_parts.pop()
        own = factors[part]
        if len(part) <= size:
            slices.append(Slice(ids[part], own, float(norms[part].max()), own.min(axis=0), own.max(axis=0)))
            continue
        low, high = own.min(axis=0).astype(np.float64), own.max(axis=0).astype(np.float64)
        boxed = np.linalg.norm(np.maximum(np.abs(low), np.abs(high))) <= _LOOSE_BOX * np.median(norms[part])
        key = own[:, int(np.argmax(high - low))] if boxed else -norms[part]
        # Whole slices on one side, so that no more slices come out than are needed.
        middle = -(-len(part) // size) // 2 * size
        order = np.argsort(key, kind="stable")
        open_parts += [part[np.sort(half)] for half in (order[:middle], order[middle:])]
    return sorted(slices, key=lambda s: (-s.norm, s.ids[0]))


def rank_candidates(
    customers: DataFrame,
    items: DataFrame,
    bought: DataFrame | None,
    k: int,
    block_items: int,
    counts: SearchCounts | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """The first ``k`` articles of every customer by the product of factors; equal products go by article index.

    ``customers`` are (customer_id, customer_idx, features), ``items`` (id, features), ``bought`` (customer_idx, article_idx)
    pairs to leave out. Articles are ordered by the norm of their factors and cut into blocks of ``block_items``, which tasks
    fetch one after the other. A task keeps the best ``k`` of each of its customers so far; no product exceeds that of the
    norms, so a slice of articles is skipped for a customer whose k-th score is above that bound, and the blocks after it are
    not even fetched when nobody needs them. Any number of blocks gives the same lists. Articles are told by their index or,
    if ``names`` (article_id, article_idx from 0) are given, by their id.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    blocks, bounds = _item_blocks(items, block_items)
    named = None if names is None else _name_blocks(names)
    if bought is None:
        rows = customers.withColumn("bought", F.array().cast("array<int>"))
    else:
        owned = bought.groupBy("customer_idx").agg(F.collect_list(F.col("article_idx").cast("int")).alias("bought"))
        rows = customers.join(owned, "customer_idx", "left")

    def fetched() -> Iterator[tuple[float, Callable[[], list[Slice]]]]:
        for bound, block in zip(bounds, blocks):
            yield bound, lambda block=block: _fetch(block)

    def ranked(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(waiting).combine_chunks()
        factors = batch["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        ids, best = _search(factors, _owned(batch["bought"].combine_chunks()), fetched(), k, counts)
        real = ids >= 0
        sizes, listed = real.sum(axis=1), ids[real]
        # Written in parts, as a customer has k rows.
        whose, position = np.repeat(np.arange(len(ids)), sizes), np.broadcast_to(np.arange(k, dtype=np.int32), real.shape)[real]
        articles = pa.array(listed.astype(np.int32)) if named is None else _names_of(named, listed)
        out = [
            batch["customer_id"].combine_chunks().take(pa.array(whose)),
            articles,
            pa.array(position),
            pa.array(sizes[whose].astype(np.int32)),
            pa.array(best[real]),
        ]
        table = pa.Table.from_arrays(out, [c.split()[0] for c in columns])
        yield from table.to_batches(max_chunksize=_PAIRS_PER_STEP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if len(batch):
                waiting.append(batch)
            if sum(map(len, waiting)) >= _CUSTOMERS_PER_PASS:
                yield from ranked(waiting)
                waiting = []
        if waiting:
            yield from ranked(waiting)

    article = "article_idx int" if names is None else "article_id string"
    columns = ["customer_id string", article, "als_rank int", "list_size int", "model_score float"]
    # Tasks get like numbers of customers, whatever their bytes: each customer is work for the whole catalogue.
    n = customers.select("customer_id").count()
    cores = customers.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-n // _CUSTOMERS_PER_PASS), min(cores, -(-n // _CUSTOMERS_PER_TASK)), 1)
    asked = rows.select("customer_id", F.col("features").cast("array<float>").alias("features"), "bought")
    return asked.repartition(tasks, "customer_id").mapInArrow(run, ", ".join(columns))


def _name_blocks(names: DataFrame) -> list[tuple[int, Broadcast]]:
    """The ids of the articles by index in blocks, each with its first index; the driver holds one block at a time."""
    sc = names.sparkSession.sparkContext
    size = names.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("article_id") + 8).alias("bytes")).first()
    per_block = max(1, size["n"] * BLOCK_NAMES // max(size["bytes"] or 0, BLOCK_NAMES))
    blocks = []
    for first in range(0, size["n"], per_block):
        with _one_block:
            own = names.filter(F.col("article_idx").between(first, first + per_block - 1)).select("article_id", "article_idx")
            ids = own.toArrow().sort_by("article_idx")["article_id"].combine_chunks()
            blocks.append((first, sc.broadcast(ids)))
    return blocks


def _names_of(blocks: list[tuple[int, Broadcast]], listed: np.ndarray) -> pa.Array:
    parts, places = [pa.array([], pa.string())], []
    for first, block in blocks:
        names = _fetch(block)
        here = np.flatnonzero((listed >= first) & (listed < first + len(names)))
        parts.append(names.take(pa.array(listed[here] - first)).cast(pa.string()))
        places.append(here)
    if len(blocks) == 1:
        return parts[1]
    order = np.empty(len(listed), np.int64)
    order[np.concatenate(places)] = np.arange(len(listed))
    return pa.concat_arrays(parts).take(pa.array(order))


def _item_blocks(items: DataFrame, block_items: int) -> tuple[list[Broadcast], list[float]]:
    """The blocks by falling norms, and the largest norm in each.

    Tasks cut the blocks into slices, one block each, and store them as bytes. The driver holds the bytes of one block at a time,
    whatever number of threads ask for theirs.
    """
    sc = items.sparkSession.sparkContext
    n_blocks = -(-items.count() // block_items)
    if n_blocks <= 1:
        placed = items.withColumn("_block", F.lit(0).cast("long"))
    else:
        squares = F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
        numbered = number_rows(items.withColumn("_norm", F.sqrt(squares)), [F.desc("_norm"), F.asc("id")], "_pos")
        placed = numbered.withColumn("_block", F.floor(F.col("_pos") / block_items))
    size = SLICE_ITEMS
    cut = placed.select("_block", F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features"))
    cut = cut.groupBy("_block").applyInArrow(
        lambda block: _slice_rows(block, size), "block long, position int, norm double, n int, ids binary, factors binary"
    )
    stored = written(cut, "item-slices")
    blocks, bounds = [], []
    for number in range(n_blocks):
        with _one_block:
            rows = stored.filter(F.col("block") == number).orderBy("position").toLocalIterator()
            slices = [_slice_of(row) for row in rows]
            bounds.append(slices[0].norm)
            blocks.append(sc.broadcast(slices))
            del slices
    return blocks, bounds


def _slice_rows(block: pa.Table, size: int) -> pa.Table:
    """The slices of a block of articles, as bytes."""
    ids = block["id"].to_numpy()
    factors = block["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(ids), -1)
    slices = norm_slices(ids, factors, size)
    return pa.table(
        {
            "block": pa.array([block["_block"][0].as_py()] * len(slices), pa.int64()),
            "position": pa.array(range(len(slices)), pa.int32()),
            "norm": pa.array([s.norm for s in slices], pa.float64()),
            "n": pa.array([len(s.ids) for s in slices], pa.int32()),
            "ids": pa.array([s.ids.tobytes() for s in slices], pa.binary()),
            "factors": pa.array([s.factors.tobytes() for s in slices], pa.binary()),
        }
    )


def _slice_of(row: Row) -> Slice:
    factors = np.frombuffer(row["factors"], np.float32).reshape(row["n"], -1)
    return Slice(np.frombuffer(row["ids"], np.int64), factors, row["norm"], factors.min(axis=0), factors.max(axis=0))


def _fetch(block: Broadcast) -> list[Slice] | pa.Array:
    read = block.value
    # A worker would keep every block that it has read.
    block.__dict__.pop("_value", None)
    return read


def rank_customers(
    batch: pd.DataFrame, blocks: Iterable[tuple[float, Callable[[], list[Slice]]]], k: int, counts: SearchCounts | None = None
) -> pd.DataFrame:
    """The first ``k`` article indices per row of (customer_id, features, bought), by score, then index.

    ``blocks`` are (largest norm, how to get the slices) by falling norms.
    """
    owned = [np.zeros(0, np.int64) if o is None else np.asarray(o, dtype=np.int64) for o in batch["bought"]]
    pairs = np.repeat(np.arange(len(owned)), [len(o) for o in owned]), np.concatenate([np.zeros(0, np.int64), *owned])
    ids, best = _search(np.stack(batch["features"].to_numpy()), pairs, blocks, k, counts)
    real = ids >= 0
    sizes = real.sum(axis=1)
    return pd.DataFrame(
        {
            "customer_id": np.repeat(batch["customer_id"].to_numpy(), sizes),
            "article_idx": ids[real].astype(np.int32),
            "als_rank": np.broadcast_to(np.arange(k), real.shape)[real].astype(np.int32),
            "list_size": np.repeat(sizes, sizes).astype(np.int32),
            "model_score": best[real],
        }
    )


def _owned(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, article) of every entry."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


class _Lists:
    """The best ``k`` articles of each customer so far, and some that wait to be merged with them.

    An article is one number: its score in the order of the bits, then its index, so that of equal scores the smaller index is
    more. 0 is no article.
    """

    def __init__(self, n: int, k: int) -> None:
        self.k, self.room = k, max(16, k // 2)
        self.keys = np.zeros((n, k + self.room), np.uint64)
        self.waiting = np.zeros(n, np.int64)
        self.worst = np.zeros(n, np.uint64)
        # The score of the k-th article.
        self.reached = np.full(n, -np.inf, np.float32)

    def add(self, rows: np.ndarray, keys: np.ndarray) -> None:
        """Articles of customers, ordered by customer."""
        while len(rows):
            keys, rows = (a[keys > self.worst[rows]] for a in (keys, rows))
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
            lengths = np.diff(np.r_[first, len(rows)])
            place = self.waiting[rows] + np.arange(len(rows)) - np.repeat(first, lengths)
            fits = place < self.room
            self.keys[rows[fits], self.k + place[fits]] = keys[fits]
            touched = rows[first]
            self.waiting[touched] = np.minimum(self.waiting[touched] + lengths, self.room)
            self.merge(touched[self.waiting[touched] >= self.room // 2])
            rows, keys = rows[~fits], keys[~fits]

    def merge(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        sorted_in = np.partition(self.keys[rows], self.room, axis=1)
        self.keys[rows, : self.k] = sorted_in[:, self.room :]
        self.keys[rows, self.k :] = 0
        self.waiting[rows] = 0
        self.worst[rows] = sorted_in[:, self.room]
        self.reached[rows] = _score_of(sorted_in[:, self.room])

    def settle(self) -> None:
        self.merge(np.flatnonzero(self.waiting))

    def last(self) -> np.ndarray:
        """The index of the k-th article, -1 where there is none."""
        return _index_of(self.worst)

    def in_order(self) -> tuple[np.ndarray, np.ndarray]:
        """Indices, -1 beyond a list's end, and scores, best first."""
        self.settle()
        keys = np.sort(self.keys[:, : self.k], axis=1)[:, ::-1]
        return _index_of(keys), _score_of(keys)


_LOW = np.uint64(0xFFFFFFFF)
_SIGN = np.uint32(0x80000000)


def _keys(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    # Adding 0 turns -0.0 into 0.0.
    bits = (scores + np.float32(0)).view(np.uint32)
    ordered = np.where(bits & _SIGN, ~bits, bits | _SIGN).astype(np.uint64)
    return ordered << np.uint64(32) | (_LOW - ids.astype(np.uint64))


def _score_of(keys: np.ndarray) -> np.ndarray:
    ordered = (keys >> np.uint64(32)).astype(np.uint32)
    scores = np.where(ordered & _SIGN, ordered ^ _SIGN, ~ordered).view(np.float32)
    return np.where(keys == 0, np.float32(-np.inf), scores)


def _index_of(keys: np.ndarray) -> np.ndarray:
    return np.where(keys == 0, -1, (_LOW - (keys & _LOW)).astype(np.int64))


def _search(
    factors: np.ndarray,
    owned: tuple[np.ndarray, np.ndarray],
    blocks: Iterable[tuple[float, Callable[[], list[Slice]]]],
    k: int,
    counts: SearchCounts | None,
) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` article indices of each row of ``factors``, -1 beyond the end of a list, and their scores.

    Products in single precision tell which articles can be among the first; the score of these is summed in double precision and
    rounded to single, so that articles with the same factors have the same score wherever they stand.
    """
    users, single = factors.astype(np.float64), factors.astype(np.float32)
    # More than any rounding can add to a product.
    reach = np.linalg.norm(users, axis=1) * (1 + 1e-6) + 1e-30
    lists = _Lists(len(users), k)
    scored = skipped = 0

    def score(part: Slice, wanted: np.ndarray, mine: tuple[np.ndarray, np.ndarray]) -> None:
        columns, wide = part.factors.astype(np.float32).T, part.factors.astype(np.float64)
        # Single precision errs by less: of the factors, of each product, and of every sum.
        slack = ((users.shape[1] + 8) * 2.0**-23 * reach * max(part.norm, 1e-30) + 1e-30).astype(np.float32)
        place = np.full(len(users), -1)
        step = max(1, _SCORES_PER_STEP // len(part.ids))
        for at in range(0, len(wanted), step):
            rows = wanted[at : at + step]
            about = single[rows] @ columns
            place[rows] = np.arange(len(rows))
            taken = place[mine[0]]
            place[rows] = -1
            about[taken[taken >= 0], mine[1][taken >= 0]] = -np.inf
            least = lists.reached[rows] - slack[rows]
            short = np.flatnonzero(np.isneginf(least))
            if len(short) and k < about.shape[1]:
                # At least k articles of this slice reach the k-th of these products less what it can err.
                kth = np.partition(about[short], -k, axis=1)[:, -k]
                least[short] = kth - 2 * slack[rows[short]]
            found = _reaching(about, np.maximum(least, np.finfo(np.float32).min))
            for first in range(0, len(found), _PAIRS_PER_STEP):
                row, column = np.divmod(found[first : first + _PAIRS_PER_STEP], about.shape[1])
                row = rows[row]
                exact = np.einsum("ij,ij->i", users[row], wide[column]).astype(np.float32)
                lists.add(row, _keys(exact, part.ids[column]))

    for bound, get in blocks:
        if not (reach * bound >= lists.reached).any():
            break
        parts = get()
        bought = _bought_in(owned, parts)
        above = _bounds(users, reach, parts)
        # The most promising slice of each customer first, so that the others are held against a good list.
        favourite = above.argmax(axis=1)
        before = scored
        for i, part in enumerate(parts):
            wanted = np.flatnonzero((favourite == i) & _open(above[:, i], part, lists))
            score(part, wanted, bought[i])
            scored += len(wanted)
        lists.settle()
        for i, part in enumerate(parts):
            wanted = np.flatnonzero((favourite != i) & _open(above[:, i], part, lists))
            score(part, wanted, bought[i])
            scored += len(wanted)
        lists.settle()
        skipped += len(users) * len(parts) - (scored - before)
    if counts is not None:
        counts.scored.add(scored)
        counts.skipped.add(skipped)
    return lists.in_order()


def _reaching(about: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The places, in the flat array, of what is not below its row's ``least``. They are few, so eight are looked at together."""
    flags = np.zeros(-(-about.size // 8) * 8, bool)
    np.greater_equal(about, least[:, None], out=flags[: about.size].reshape(about.shape))
    eights = np.flatnonzero(flags.view(np.uint64))
    places = (eights[:, None] * 8 + np.arange(8)).ravel()
    return places[flags[places]]


def _bought_in(owned: tuple[np.ndarray, np.ndarray], parts: list[Slice]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each slice the (row, position in the slice) of the pairs in ``owned``."""
    ids = np.concatenate([p.ids for p in parts])
    sizes = [len(p.ids) for p in parts]
    starts = np.cumsum([0, *sizes[:-1]])
    order = np.argsort(ids, kind="stable")
    found = order[np.minimum(np.searchsorted(ids, owned[1], sorter=order), len(ids) - 1)]
    here = np.flatnonzero(ids[found] == owned[1])
    part = np.searchsorted(starts, found[here], side="right") - 1
    by_part = np.argsort(part, kind="stable")
    rows, places = owned[0][here][by_part], (found[here] - starts[part])[by_part]
    cuts = np.searchsorted(part[by_part], np.arange(1, len(parts)))
    return list(zip(np.split(rows, cuts), np.split(places, cuts)))


def _bounds(users: np.ndarray, reach: np.ndarray, parts: list[Slice]) -> np.ndarray:
    """What no score of a customer with an article of a slice exceeds, (customers, slices) in single precision.

    A product of factors is at most that of the norms, and at most that with the best corner of the slice's box.
    """
    low, high = (np.stack([getattr(p, side) for p in parts]).astype(np.float64) for side in ("low", "high"))
    norms = np.array([p.norm for p in parts])
    corners = np.maximum(users, 0) @ high.T + np.minimum(users, 0) @ low.T
    # More than the sums can be rounded by, on either side.
    corner_norms = np.linalg.norm(np.maximum(np.abs(low), np.abs(high)), axis=1)
    corners += users.shape[1] * 1e-15 * reach[:, None] * corner_norms
    return np.minimum(corners, reach[:, None] * norms).astype(np.float32)


def _open(above: np.ndarray, part: Slice, lists: _Lists) -> np.ndarray:
    """For which customers the slice can hold an article that belongs into the list: equal scores go by index."""
    last = lists.last()
    return (above > lists.reached) | (above == lists.reached) & ((last < 0) | (part.ids[0] < last))


# Fits and evaluations that run at the same time.
GRID_JOBS = 4


def _grid_points(
    given: ALSInput, truth: DataFrame, points: dict[int, ALSParams], k: int, users: DataFrame | None, jobs: int
) -> dict[int, DataFrame]:
    """Parameters and metrics of each point, a stored table of one row.

    Points are fitted and evaluated by ``jobs`` threads at a time, each in a pool of its own: with
    ``spark.scheduler.mode`` FAIR they share the executors, so one's short stages fill the gaps of another's.
    """
    from basketlens.operators.metrics import mean_metrics, per_user_metrics

    spark = truth.sparkSession
    asked = truth if users is None else truth.join(users, "customer_id", "left_semi")

    def measured(config: int, params: ALSParams) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{config}")
        try:
            model = ALSCandidates.fit_input(given, params)
            known = model.known(asked)
            recs = model.recommend(known, k).withColumn("rank", F.col("als_rank") + 1)
            scores = per_user_metrics(recs, asked, k).join(known, "customer_id", "left_semi")
            row = mean_metrics(scores).select(
                F.lit(config).alias("config"),
                *[F.lit(v).alias(name) for name, v in asdict(params).items()],
                "recall",
                "hit_rate",
                "n_users",
            )
            return written(row, "grid-point")
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, jobs)) as pool:
        started = {
            config: pool.submit(inheritable_thread_target(spark)(measured), config, params)
            for config, params in points.items()
        }
        return {config: one.result() for config, one in started.items()}


def als_grid(
    train: DataFrame,
    truth: DataFrame,
    grid: list[ALSParams],
    k: int = S.N_CANDIDATES,
    users: DataFrame | None = None,
    jobs: int = GRID_JOBS,
) -> DataFrame:
    """Recall and hit rate at ``k`` per parameter set on the known customers of ``truth``, best first.

    The grid is a short driver-side list; every fit and every evaluation is a distributed job, ``jobs`` points at a
    time. Purchases are counted and ids numbered once for the whole grid.
    """
    if not grid:
        raise ValueError("the grid is empty")
    shared_dir(train.sparkSession)
    rows = _grid_points(ALSInput.of(train), truth, dict(enumerate(grid)), k, users, jobs)
    return reduce(DataFrame.unionByName, rows.values()).orderBy(F.desc("recall"), "config")


def als_halving(
    train: DataFrame,
    truth: DataFrame,
    grid: list[ALSParams],
    k: int = S.N_CANDIDATES,
    users: DataFrame | None = None,
    jobs: int = GRID_JOBS,
    keep: int = 2,
) -> DataFrame:
    """Successive halving: the grid with few iterations first, and more only for its better part.

    In each round the best one in ``keep`` points (rounded up; equal recall goes by position) stay, until one is left; it is
    measured with its own iterations. The round before has one ``keep``-th of them, and so on, at least one. Every
    point is reported with the last ``round`` (from 0) that it took part in, the ``fitted_iterations`` there and the metrics
    of that fit; the point that stayed is first.
    """
    if not grid:
        raise ValueError("the grid is empty")
    if keep < 2:
        raise ValueError("a round must leave out at least every second point")
    shared_dir(train.sparkSession)
    given = ALSInput.of(train)
    sizes = [len(grid)]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // keep))
    left, rows = list(range(len(grid))), []
    for number, size in enumerate(sizes):
        share = keep ** (len(sizes) - 1 - number)
        points = {c: replace(grid[c], iterations=max(1, grid[c].iterations // share)) for c in left}
        found = _grid_points(given, truth, points, k, users, jobs)
        recall = {c: row.first()["recall"] or 0.0 for c, row in found.items()}
        staying = sorted(left, key=lambda c: (-recall[c], c))[: sizes[number + 1]] if number + 1 < len(sizes) else []
        rows += [
            found[c].withColumnsRenamed({"iterations": "fitted_iterations"}).withColumns(
                {"round": F.lit(number), "iterations": F.lit(grid[c].iterations)}
            )
            for c in left
            if c not in staying
        ]
        left = staying
    order = [F.desc("round"), F.desc("recall"), "config"]
    return reduce(DataFrame.unionByName, rows).orderBy(*order)
