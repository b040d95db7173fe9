"""Spelling variants of words by k-d trees over letter-count vectors.

A word is described by how often each letter stands in it. One inserted or deleted letter changes this vector by one in
one place, one replaced letter by one up and one down in two places: the L1 distance is one or two. Words of one length
form a k-d tree; a search for the words of the same length may leave the box of the query by one step down and one step
up, a search among the words one letter longer by one step up only. All other boxes are pruned. What lies within reach
is verified by the order of the letters.

The same tree is used twice. An upper tree, made from a bounded sample of the vocabulary, cuts it into cells of about
``cell_words`` words; a word goes to its own cell, and as a query to the few others within reach. A task builds the tree
of its cell and searches it for all its queries at once, so it sends on one row per word: the number of near words and
the most frequent of them, never the pairs. A cell that the tree cannot cut, because its words have the same letters, may
stay too large; its words meet by patterns with one letter left out instead, of which each has a bounded number of words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.plans.workspace import written

MIN_LENGTH = 7
MIN_COUNT = 2
# A form must be so many times as frequent as its variant.
FORM_FACTOR = 10
# One word in so many is damaged, if damage is asked for.
DAMAGE_EACH = 31
# Words from which the upper tree is made, and the words that one of its cells should have.
SAMPLE_WORDS = 100_000
CELL_WORDS = 16_384
# A cell of more words than this meets by patterns.
MAX_CELL_WORDS = 8 * CELL_WORDS
# Vectors in a leaf of a task's tree, and pairs of words verified at a time.
_LEAF = 128
_PAIRS = 500_000
# Words counted by a task before it sends on what it has.
_COUNTED = 300_000
# Letters are code points below 256, so a word is a row of bytes in Latin-1.
_LETTERS = [*range(97, 123), *range(65, 91), *range(0xC0, 0x100)]
_PLACE = np.zeros(256, np.int64)
_PLACE[_LETTERS] = np.arange(len(_LETTERS))
_RANK_BITS = 24


# ---- words ----------------------------------------------------------------------------------------------


def _counted(min_length: int, damage: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # A-Z are lower-cased before; U+00C0 to U+00FF are two octets in UTF-8, and no other letter begins with C3.
    runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % min_length)

    def batch(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for rows in batches:
            for mark, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                found = runs.findall(text.as_py().lower()) if text.is_valid else ()
                if not damage:
                    counts.update(found)
                    continue
                begun = zlib.crc32(f"{'' if mark is None else mark}:".encode())
                for word, n in Counter(found).items():
                    h = zlib.crc32(word, begun)
                    if h % DAMAGE_EACH == 0:
                        letters = word.decode()
                        at = h % len(letters)
                        if len(letters) <= min_length:
                            continue
                        word = (letters[:at] + letters[at + 1 :]).encode()
                    counts[word] += n
            if len(counts) > _COUNTED:
                yield batch(counts)
                counts = Counter()
        yield batch(counts)

    return run


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: bool = False
) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text, …) with ``min_length`` letters or more that occur ``min_count`` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF; A-Z are lower-cased, nothing else. With ``damage`` a word
    loses one letter where 31 divides the CRC-32 h of ``<doc_id>:<word>``: the one at h % length; what is then too short is
    no word. A null text has no words, a null doc_id counts as empty, repeated rows count each. Other columns are not read.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(_counted(min_length, damage), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- the tree -------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A split (letter, most on the left, two children), or a leaf with its number and the rows that it was made of."""

    letter: int = -1
    most: int = 0
    left: Node | None = None
    right: Node | None = None
    number: int = -1
    rows: np.ndarray | None = None


def build_tree(vectors: np.ndarray, leaf: int) -> tuple[Node, int]:
    """The tree over the rows of ``vectors`` with leaves of at most ``leaf`` rows, if they differ, and its number of leaves."""
    n_leaves = 0

    def grow(rows: np.ndarray) -> Node:
        nonlocal n_leaves
        if len(rows) > leaf:
            own = vectors[rows]
            # Of the splits beside the letters' medians, the one that leaves the two sides most alike.
            best = (0, 0, 0)
            middle = np.partition(own, len(own) // 2, axis=0)[len(own) // 2]
            for most in (middle - 1, middle):
                below = (own <= most).sum(axis=0)
                even = np.minimum(below, len(rows) - below)
                letter = int(even.argmax())
                best = max(best, (int(even[letter]), -int(most[letter]), -letter))
            if best[0]:
                most, letter = -best[1], -best[2]
                go = own[:, letter] <= most
                return Node(letter, most, grow(rows[go]), grow(rows[~go]))
        n_leaves += 1
        return Node(number=n_leaves - 1, rows=rows)

    return grow(np.arange(len(vectors))), n_leaves


def within_reach(tree: Node, vectors: np.ndarray, down: bool) -> Iterator[tuple[Node, np.ndarray]]:
    """Each leaf with the rows of ``vectors`` for which it may hold a vector with one letter more, and with ``down`` one less.

    A box is left only over a border that the row touches, as a count differs by one at most; going up and going down are
    possible once each.
    """
    stack = [(tree, np.arange(len(vectors)), np.zeros(len(vectors), bool), np.full(len(vectors), not down))]
    while stack:
        node, rows, up, low = stack.pop()
        if not len(rows):
            continue
        if node.left is None:
            yield node, rows
            continue
        have = vectors[rows, node.letter]
        fewer, fits = (have == node.most + 1) & ~low, have <= node.most
        more = (have == node.most) & ~up
        go = fits | fewer
        stack.append((node.left, rows[go], up[go], (low | fewer)[go]))
        go = ~fits | more
        stack.append((node.right, rows[go], (up | more)[go], low[go]))


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length, given as rows of Latin-1 bytes."""
    n, length = codes.shape
    flat = np.repeat(np.arange(n), length) * len(_LETTERS) + _PLACE[codes].ravel()
    return np.bincount(flat, minlength=n * len(_LETTERS)).reshape(n, -1).astype(np.int32)


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes."""
    joined = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return joined.reshape(len(words), -1)


# ---- cells ----------------------------------------------------------------------------------------------


def upper_trees(sample: list[str], n_words: int, cell_words: int) -> dict[int, Node]:
    """Tree by word length, made from a sample of ``n_words`` words so that a leaf stands for about ``cell_words``."""
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    leaf = max(1, round(cell_words * len(sample) / max(1, n_words)))
    trees = {}
    for length, words in by_length.items():
        if len(words) > leaf:
            trees[length] = build_tree(letter_counts(_codes(words)), leaf)[0]
            _forget(trees[length])
    return trees


def _forget(node: Node) -> None:
    """Drop the sampled rows, which nothing needs any more."""
    node.rows = None
    for child in (node.left, node.right):
        if child is not None:
            _forget(child)


_SINGLE = Node(number=0)
# What a row is in a cell: a word of the cell, a query of the same length, a query one letter shorter.
_OWN, _SAME, _SHORTER = 0, 1, 2


def _dealt(trees: dict[int, Node]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            out: list[list[np.ndarray]] = [[], [], [], []]  # length of the cell's words, cell, kind, row

            def put(length: int, cell: int, kind: int, rows: np.ndarray) -> None:
                for column, value in zip(out, (length, cell, kind)):
                    column.append(np.full(len(rows), value))
                out[3].append(rows)

            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                vectors = letter_counts(_codes([words[i] for i in rows]))
                home = np.empty(len(rows), np.int64)
                tree = trees.get(length, _SINGLE)
                stack = [(tree, np.arange(len(rows)))]
                while stack:
                    node, mine = stack.pop()
                    if node.left is None:
                        home[mine] = node.number
                        put(length, node.number, _OWN, rows[mine])
                    else:
                        go = vectors[mine, node.letter] <= node.most
                        stack += [(node.left, mine[go]), (node.right, mine[~go])]
                for node, near in within_reach(tree, vectors, down=True):
                    put(length, node.number, _SAME, rows[near[home[near] != node.number]])
                for node, near in within_reach(trees.get(length + 1, _SINGLE), vectors, down=False):
                    put(length + 1, node.number, _SHORTER, rows[near])
            if not len(words):
                continue
            length, cell, kind, rows = (np.concatenate(c) for c in out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(length, pa.int32()),
                    pa.array(cell, pa.int32()),
                    pa.array(kind, pa.int32()),
                    batch.column(0).take(pa.array(rows)),
                    pa.array(n[rows]),
                ],
                ["length", "cell", "kind", "word", "n"],
            )

    return run


def _same_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_longer(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` is ``short`` with one letter put in: what they share at both ends makes up all of ``short``."""
    n = short.shape[1]
    front = short == long[:, :n]
    back = (short == long[:, 1:])[:, ::-1]
    shared = np.where(front.all(axis=1), n, front.argmin(axis=1)) + np.where(back.all(axis=1), n, back.argmin(axis=1))
    return shared >= n


def _groups(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the rows sorted by them, and where each one's begin."""
    marks = np.ascontiguousarray(vectors.astype(np.uint16)).view(f"V{2 * vectors.shape[1]}").ravel()
    _, first, which = np.unique(marks, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    return vectors[first], order, np.searchsorted(which[order], np.arange(len(first) + 1))


def near_pairs(
    queries: np.ndarray, stored: np.ndarray, leaf: int = _LEAF
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``queries`` and ``stored`` that differ by one edit; words as bytes, the stored ones as long or one longer."""
    longer = stored.shape[1] - queries.shape[1]
    if not len(queries) or not len(stored):
        return
    mine, my_order, my_starts = _groups(letter_counts(queries))
    theirs, their_order, their_starts = _groups(letter_counts(stored))
    used = theirs.any(axis=0) | mine.any(axis=0)
    mine, theirs = mine[:, used], theirs[:, used]
    tree, _ = build_tree(theirs, leaf)
    a, b = mine.astype(np.float32), theirs.astype(np.float32)
    a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
    verify = _one_longer if longer else _same_length
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = 0

    def verified() -> tuple[np.ndarray, np.ndarray]:
        q, s = (np.concatenate(x) for x in zip(*held))
        go = verify(queries[q], stored[s])
        return q[go], s[go]

    my_sizes, their_sizes = np.diff(my_starts), np.diff(their_starts)
    for node, rows in within_reach(tree, mine, down=not longer):
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            # Counts that sum up alike and are one step apart have a squared distance of 2, of 1 if one is longer.
            apart = a2[part][:, None] + b2[node.rows][None, :] - 2 * (a[part] @ b[node.rows].T)
            i, j = np.nonzero(np.abs(apart - (1 if longer else 2)) < 0.5)
            i, j = part[i], node.rows[j]
            # All words of the one vector with all of the other, some pairs at a time.
            sizes = my_sizes[i] * their_sizes[j]
            ends = np.cumsum(sizes)
            done = 0
            while done < (ends[-1] if len(ends) else 0):
                upto = min(done + _PAIRS, int(ends[-1]))
                flat = np.arange(done, upto)
                pair = np.searchsorted(ends, flat, side="right")
                inner = flat - (ends[pair] - sizes[pair])
                u, v = i[pair], j[pair]
                held.append((
                    my_order[my_starts[u] + inner // their_sizes[v]], their_order[their_starts[v] + inner % their_sizes[v]]
                ))
                n_held += len(flat)
                done = upto
                if n_held >= _PAIRS:
                    yield verified()
                    held, n_held = [], 0
    if held:
        yield verified()


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by length, cell and kind. One row per word that has near words in the cell."""

    def search(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        kind, n = table["kind"].to_numpy(), table["n"].to_numpy()
        words = table["word"].to_pylist()
        order = np.empty(len(words), np.int64)
        by_word = sorted(range(len(words)), key=words.__getitem__)
        order[by_word] = np.arange(len(words))
        # Larger n is better, then the smaller word.
        worth = (n << _RANK_BITS) | ((1 << _RANK_BITS) - 1 - order)
        near, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
        own = np.flatnonzero(kind == _OWN)
        if len(own):
            stored = _codes([words[i] for i in own])
            same = np.flatnonzero(kind <= _SAME)
            for a, b in near_pairs(_codes([words[i] for i in same]), stored):
                a, b = same[a], own[b]
                np.add.at(near, a, 1)
                np.maximum.at(best, a, worth[b])
            short = np.flatnonzero(kind == _SHORTER)
            if len(short):
                for a, b in near_pairs(_codes([words[i] for i in short]), stored):
                    a, b = short[a], own[b]
                    for x, y in ((a, b), (b, a)):
                        np.add.at(near, x, 1)
                        np.maximum.at(best, x, worth[y])
        found = np.flatnonzero(near)
        rank = (1 << _RANK_BITS) - 1 - (best[found] & ((1 << _RANK_BITS) - 1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in found], pa.string()),
                pa.array(near[found]),
                pa.array(best[found] >> _RANK_BITS),
                pa.array([words[by_word[r]] for r in rank], pa.string()),
            ],
            ["word", "n_near", "near_n", "near"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column("length").to_numpy().astype(np.int64) << 32 | batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if held and (held[0]["length"][0], held[0]["cell"][0]) != (part["length"][0], part["cell"][0]):
                yield search(held)
                held = []
            held.append(part)
    if held:
        yield search(held)


def _by_patterns(rows: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of cells that are too large: words of a cell that share a pattern are near.

    A pattern is a word with one letter left open, or, for words one letter apart in length, left out. Some hundred words at most
    share one, as they differ in that letter only.
    """
    word, places = F.col("word"), F.sequence(F.lit(1), F.char_length("word"))
    without = F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(1 << 20))))
    opened = F.transform(
        places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.lit("*"), F.substring(word, i + 1, F.lit(1 << 20)))
    )
    own, same, short = (F.col("kind") == k for k in (_OWN, _SAME, _SHORTER))
    left_out = F.when(own, F.array_distinct(without)).when(short, F.array(word))
    patterns = F.concat(F.when(own | same, opened).otherwise(F.array()), F.coalesce(left_out, F.array()))
    met = rows.select("length", "cell", "kind", "word", "n", F.explode(patterns).alias("pattern"))
    a, b = met.alias("a"), met.where(own).alias("b")
    keys = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("length", "cell", "pattern")]
    pairs = a.join(b, [*keys, F.col("a.word") != F.col("b.word")])
    # Words of the cell meet each other by open patterns only, as one that is left out says nothing about equal lengths.
    pairs = pairs.where((F.col("a.kind") == _SHORTER) | F.contains("a.pattern", F.lit("*")))
    pairs = pairs.select("a.kind", *[F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("word", "n")]).distinct()
    there = pairs.select(F.col("word_a").alias("word"), F.col("n_b").alias("near_n"), F.col("word_b").alias("near"))
    back = pairs.where(F.col("kind") == _SHORTER)
    back = back.select(F.col("word_b").alias("word"), F.col("n_a").alias("near_n"), F.col("word_a").alias("near"))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    told = there.unionByName(back).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    return told.select("word", "n_near", (-F.col("best.m")).alias("near_n"), "best.near")


def near_words(
    words: DataFrame,
    cell_words: int = CELL_WORDS,
    max_cell_words: int = MAX_CELL_WORDS,
    sample_words: int = SAMPLE_WORDS,
) -> DataFrame:
    """(word, n, n_near, near_n, near) for every row of ``words`` (word, n), which must be a stored table of distinct words.

    Words are near if they differ by exactly one inserted, deleted or replaced letter; letters are code points U+0041 to
    U+00FF. ``near`` is the near word with the largest ``n``, the smallest in code-point order among several. Words without any
    have ``n_near`` 0 and nulls. About ``sample_words`` words make the upper tree; all words are in it.
    """
    n_words = words.count()
    # The words with the smallest hashes, about ``sample_words`` of them.
    share = F.lit(int(2**31 * min(1.0, sample_words / max(1, n_words))))
    sample = words.where(F.pmod(F.xxhash64("word"), F.lit(2**31)) < share).select("word").toPandas()["word"].tolist()
    trees = upper_trees(sorted(sample), n_words, cell_words)
    schema = "length int, cell int, kind int, word string, n long"
    # A pass over the vocabulary that deals a word to its cells costs less than a table of what was dealt.
    dealt = words.select("word", "n").mapInArrow(_dealt(trees), schema)
    sizes = dealt.groupBy("length", "cell").agg(F.count_if(F.col("kind") == _OWN).alias("size"))
    large = written(sizes.where(F.col("size") > max_cell_words).select("length", "cell"), "large-cells")
    small = dealt if large.isEmpty() else dealt.join(large, ["length", "cell"], "left_anti")
    keys = ["length", "cell"]
    # Cells are dealt to tasks one by one, so that no task gets many by chance.
    tasks = max(1, sizes.count())
    found = (
        small.repartition(min(tasks, _partitions(words)), *keys)
        .sortWithinPartitions(*keys, "kind")
        .mapInArrow(_searched, "word string, n_near long, near_n long, near string")
    )
    if not large.isEmpty():
        found = found.unionByName(_by_patterns(dealt.join(large, keys)))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    told = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return words.join(told, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("best.m")).alias("near_n"),
        F.col("best.near").alias("near"),
    )


def _partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def group_variants(words: DataFrame, factor: int = FORM_FACTOR, **tree: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n).

    A word's form is its most frequent near word, if that is ``factor`` times as frequent as itself, else null; its root
    is what following the forms ends at. A form is more frequent than its word, so there are no cycles, and the steps are
    as many as ``factor`` goes into the largest count.
    """
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    vocabulary = written(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    known = written(near_words(vocabulary, **tree), "near-words")
    is_form = F.col("near_n") >= F.col("n") * factor
    known = known.withColumns({"form": F.when(is_form, F.col("near")), "form_n": F.when(is_form, F.col("near_n"))})
    forms = written(known.where(F.col("form").isNotNull()).select("word", "form"), "forms")
    step = forms.select(F.col("word").alias("_from"), F.col("form").alias("_to"))
    roots, moving = None, forms.withColumnRenamed("form", "root")
    while True:
        on = written(moving.join(step, moving["root"] == step["_from"], "left"), "roots")
        ended = on.where(F.col("_to").isNull()).select("word", "root")
        roots = ended if roots is None else roots.unionByName(ended)
        moving = on.where(F.col("_to").isNotNull()).select("word", F.col("_to").alias("root"))
        if moving.isEmpty():
            break
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
