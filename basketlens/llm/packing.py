"""Hierarchical packing of token sequences into windows of several lengths.

Documents are routed by length to the shortest tier (a power of two) they fit; documents longer than the longest
window are cut into whole windows first. Tiers are packed from the longest: each window takes a document of its
tier, then its gap is filled with the longest shorter documents that fit, and the last gap with the front of one
more, whose rest goes back to its tier. Every window is thus full, and a full window has a power of two of
tokens; what is left at the end is cut into powers of two as well.

Each task packs its own documents, in pools of a bounded number of tokens, so nothing is shuffled and no task
grows with the corpus. The windows of a task are dealt into step groups of nearly equal numbers of tokens.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LONGEST = 4096
# Tiers go down from LONGEST by halves; below, only the rest of a task is cut.
SHORTEST = 128
END = 2
# Tokens that are packed together, and tokens of a training step.
POOL_TOKENS = 4_000_000
STEP_TOKENS = 64 * LONGEST
# Words, and pieces of words, whose ids a worker keeps, and their longest.
CACHE_WORDS = 200_000
CACHE_LENGTH = 64

_TASK_BITS = 36

# ---- tokens ------------------------------------------------------------------------------------------------

# Characters whose lower case and composition are plain: ASCII and the letters of Latin-1 and Latin Extended-A.
_PLAIN = regex.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+")


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from
    256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class WordTokens:
    """Token ids of a text as little-endian 32-bit numbers, a word at a time.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words. Words
    of plain characters go straight to the tokenizer's model, after its own splitting rule; other words go
    through the whole tokenizer. Frequent words, and pieces of words, are remembered.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rule = json.load(file)
        split = rule["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = [t["content"] for t in rule["added_tokens"]]
        self.split = regex.compile(split).findall
        self.model = self.tokenizer.model
        self.characters = _byte_characters()
        self.number = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.characters)
        number = self.number
        found = b"".join([number[t.id] for t in self.model.tokenize(mapped)])
        if len(self.pieces) < CACHE_WORDS and len(piece) <= CACHE_LENGTH:
            self.pieces[piece] = found
        return found

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word) or "|" in word and any(s in word for s in self.special):
            number = self.number
            return b"".join([number[i] for i in self.tokenizer.encode(word, add_special_tokens=False).ids])
        low = word.lower()
        known = self.pieces.get
        # Letters alone are one piece, and so are they before a single mark.
        if low.isalpha():
            parts = [low]
        elif low[-1] in ".,;:!?" and low[:-1].isalpha():
            parts = [low[:-1], low[-1]]
        else:
            parts = self.split(low)
        return b"".join([known(p) or self._piece(p) for p in parts])

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        known, out = self.words.get, []
        for word in text.replace("\n", " ").split(" "):
            if word:
                found = known(word)
                if found is None:
                    found = self._word(word)
                    if len(self.words) < CACHE_WORDS and len(word) <= CACHE_LENGTH:
                        self.words[word] = found
                out.append(found)
        return b"".join(out)


_tokens: dict[str, WordTokens] = {}


def _tokenizer(path: str) -> WordTokens:
    """One per worker process, so that known words outlive a task."""
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


# ---- packing -----------------------------------------------------------------------------------------------


@dataclass(slots=True)
class Piece:
    """``length`` ids of a document from ``start`` on."""

    doc: int
    start: int
    length: int


class Pool:
    """Pieces of at most ``longest`` ids by length; finds the longest that fits a gap."""

    def __init__(self, longest: int) -> None:
        self.by_length: list[list[Piece]] = [[] for _ in range(longest + 1)]
        self.filled = 0
        self.tokens = 0

    def add(self, piece: Piece) -> None:
        self.by_length[piece.length].append(piece)
        self.filled |= 1 << piece.length
        self.tokens += piece.length

    def longest_within(self, gap: int) -> int:
        return (self.filled & ((1 << (gap + 1)) - 1)).bit_length() - 1

    def take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.filled ^= 1 << length
        self.tokens -= length
        return piece


@dataclass(slots=True)
class Window:
    tier: int
    pieces: list[Piece] = field(default_factory=list)


def _fill(pool: Pool, window: Window, gap: int) -> int:
    """Fill ``gap`` from the pool, whole pieces first, then the front of a longer one. Returns what stays open."""
    while gap and pool.tokens:
        length = pool.longest_within(gap)
        if length > 0:
            window.pieces.append(pool.take(length))
            gap -= length
        else:
            # Only longer pieces are left: cut the shortest of them.
            piece = pool.take((pool.filled & -pool.filled).bit_length() - 1)
            window.pieces.append(Piece(piece.doc, piece.start, gap))
            pool.add(Piece(piece.doc, piece.start + gap, piece.length - gap))
            gap = 0
    return gap


def pack_pool(pool: Pool, longest: int = LONGEST, shortest: int = SHORTEST, last: bool = True) -> list[Window]:
    """Full windows from the pool, tier by tier from the longest.

    With ``last`` the pool is emptied: the rest is cut into powers of two. Otherwise pieces of less than the shortest
    tier in all stay for the next pool.
    """
    windows: list[Window] = []
    tier = longest
    while tier >= shortest:
        below = tier // 2 if tier > shortest else 0
        while pool.filled >> (below + 1) and pool.tokens >= tier:
            length = pool.longest_within(tier)
            if length <= below:
                break
            window = Window(tier, [pool.take(length)])
            _fill(pool, window, tier - length)
            windows.append(window)
        tier //= 2
    size = longest
    while size >= (1 if last else shortest):
        while pool.tokens >= size:
            window = Window(size)
            _fill(pool, window, size)
            windows.append(window)
        size //= 2
    return windows


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group of each window: as many groups as steps are needed, windows from the longest to the emptiest."""
    n = max(1, -(-sum(sizes) // step_tokens))
    loads = [(0, g) for g in range(n)]
    groups = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heapq.heappop(loads)
        groups[i] = g
        heapq.heappush(loads, (load + sizes[i], g))
    return groups


_FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids", pa.binary()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("tier", pa.int32()),
    ("step_group", pa.int64()),
]
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, "
    "step_group long"
)
# Pieces in one outgoing batch.
_OUT_ROWS = 5000


def _pack(
    path: str, longest: int, shortest: int, pool_tokens: int, step_tokens: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokenizer(path)
        first = TaskContext.get().partitionId() << _TASK_BITS
        pool, docs = Pool(longest), {}
        n_docs = n_windows = n_groups = 0

        def rows(windows: list[Window]) -> Iterator[pa.RecordBatch]:
            nonlocal n_windows, n_groups
            groups = step_groups([w.tier for w in windows], step_tokens)
            out: list[list] = [[] for _ in range(9)]
            for window, group in zip(windows, groups):
                offset = 0
                for p in window.pieces:
                    doc_id, ids = docs[p.doc]
                    part = ids[4 * p.start : 4 * (p.start + p.length)]
                    row = (
                        doc_id, p.start, p.length, part, len(ids) // 4, first + n_windows, offset, window.tier,
                        first + n_groups + group,
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                    offset += p.length
                n_windows += 1
                if len(out[0]) >= _OUT_ROWS:
                    yield _batch(out)
                    out = [[] for _ in range(9)]
            n_groups += max(groups, default=-1) + 1
            yield _batch(out)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = tokens.ids(text.as_py()) + END.to_bytes(4, "little")
                docs[n_docs] = doc_id.as_py(), ids
                n = len(ids) // 4
                for start in range(0, n, longest):
                    pool.add(Piece(n_docs, start, min(longest, n - start)))
                n_docs += 1
                if pool.tokens >= pool_tokens:
                    yield from rows(pack_pool(pool, longest, shortest, last=False))
                    left = {p.doc for pieces in pool.by_length for p in pieces}
                    docs = {k: docs[k] for k in left}
        if pool.tokens:
            yield from rows(pack_pool(pool, longest, shortest))

    return run


def _batch(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[kind for _, kind in _FIELDS]]
    arrays = [pa.array(column, kind) for column, kind in zip(out, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", *[name for name, _ in _FIELDS]])


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int = LONGEST,
    shortest: int = SHORTEST,
    pool_tokens: int = POOL_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece of every document of ``docs`` (doc_id, text, …).

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers, ``start`` the document's ids before
    it, ``doc_tokens`` the document's ids with the end token, ``offset`` the place in its sequence, ``tier`` the
    length of that sequence, ``step_group`` the training step. Null and empty texts are the end token alone. Repeated
    rows, and rows without doc_id, are documents of their own. Other columns are not read. No rows give none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pack(tokenizer_path, longest, shortest, pool_tokens, step_tokens), SCHEMA)
