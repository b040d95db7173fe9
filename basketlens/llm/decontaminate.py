"""Benchmark decontamination with a generalised suffix automaton over words.

Items and documents are normalised alike: A-Z lower-cased, words are runs of ASCII letters, digits and non-ASCII
characters. The automaton holds every word sequence of every item. A document is streamed through it; after each
word the automaton's state and the matched length say how many of the last words occur in some item. Once the
length reaches the window, the words of the window are hit, and the state's items have it.

Items are dealt into blocks of a bounded number of words, each with an automaton of its own, so that what a task
holds is bounded; the documents pass through all blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 10
# Words of items in one automaton; a state takes a few hundred bytes and there are at most two per word.
BLOCK_WORDS = 500_000
# Words of items in all; a larger query set is refused, as every executor holds all of it.
MAX_WORDS = 20_000_000

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
# One translation lower-cases A-Z and turns every other byte that is no part of a word into a space.
_NORMAL = bytes(c if c in _WORD else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton of items (id, words), with the items of each window.

    State v stands for word sequences that end at the same places; ``length[v]`` is the longest, ``link[v]``
    the state of the longest suffix that ends at more places.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [
            (item, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words])
            for item, words in items
            if words
        ]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        # What ends in a state: for a whole window the items that have it; for a shorter item itself.
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, codes in coded:
            self._register(item, codes)
        self.shortest = min([min(window, len(codes)) for _, codes in coded], default=0)
        self._pairs(coded)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, parent: int, code: int) -> int:
        """The state of parent's longest sequence followed by code, on its own."""
        child = self.step[parent][code]
        if self.length[child] == self.length[parent] + 1:
            return child
        twin = self._state(self.length[parent] + 1, self.link[child], dict(self.step[child]))
        self.link[child] = twin
        while parent >= 0 and self.step[parent].get(code) == child:
            self.step[parent][code] = twin
            parent = self.link[parent]
        return twin

    def _extend(self, last: int, code: int) -> int:
        if code in self.step[last]:
            return self._split(last, code)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and code not in self.step[at]:
            self.step[at][code] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, code)
        return new

    def advance(self, state: int, matched: int, code: int) -> tuple[int, int]:
        """The state and matched length after one more word."""
        step, link = self.step, self.link
        while state and code not in step[state]:
            state = link[state]
            matched = self.length[state]
        if code in step[state]:
            return step[state][code], matched + 1
        return 0, 0

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a match that ends in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _register(self, item: str, codes: list[int]) -> None:
        state = matched = 0
        for code in codes:
            state, matched = self.advance(state, matched, code)
            if matched >= self.window:
                self.windows.setdefault(self._suffix(state, self.window), set()).add(item)
        if len(codes) < self.window:
            ends = self.short.setdefault(self._suffix(state, len(codes)), {})
            ends.setdefault(len(codes), set()).add(item)

    def _pairs(self, coded: list[tuple[str, list[int]]]) -> None:
        """Successive words of items, to pass over stretches where no window can lie."""
        self.base = len(self.vocabulary) + 1
        seen = {a * self.base + b for _, codes in coded for a, b in zip(codes, codes[1:])}
        self.pairs = np.array(sorted(seen), np.int64)

    def stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches in which every word and every successive pair are known, long enough for a window."""
        known = codes > 0
        if self.shortest == 1:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
            yield from zip(edges[::2].tolist(), edges[1::2].tolist())
            return
        if len(codes) < 2 or not len(self.pairs):
            return
        pair = codes[:-1] * self.base + codes[1:]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        follows = (self.pairs[place] == pair) & known[:-1] & known[1:]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], follows.view(np.int8), [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + 1 >= self.shortest:
                yield a, b + 1

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches of words [start, end) in order, and the items with occurring windows."""
        code = self.vocabulary.get
        codes = np.fromiter((code(w, 0) for w in words), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for a, b in self.stretches(codes):
            state = matched = 0
            for at in range(a, b):
                state, matched = self.advance(state, matched, int(codes[at]))
                hit = 0
                if matched >= self.window:
                    found = self.windows.get(self._suffix(state, self.window))
                    if found:
                        items |= found
                        hit = self.window
                if self.short:
                    hit = max(hit, self._short_ends(state, matched, items))
                if hit:
                    _add(spans, at + 1 - hit, at + 1)
        return spans, items

    def _short_ends(self, state: int, matched: int, items: set[str]) -> int:
        hit = 0
        while state > 0:
            for length, found in self.short.get(state, {}).items():
                if length <= matched:
                    items |= found
                    hit = max(hit, length)
            state = self.link[state]
        return hit


def _add(spans: list[tuple[int, int]], a: int, b: int) -> None:
    while spans and spans[-1][1] >= a:
        last = spans.pop()
        a, b = min(a, last[0]), max(b, last[1])
    spans.append((a, b))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        _add(out, a, b)
    return out


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> list[list[tuple[str, list[bytes]]]]:
    """The query set (item_id, text) in blocks of at most ``block_words`` words, or one item.

    The items are the operator's stated query set, refused beyond MAX_WORDS. A null item_id is called "null";
    items without words have no window.
    """
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    blocks: list[list[tuple[str, list[bytes]]]] = []
    size = total = 0
    for row in rows.where(F.col("text").isNotNull()).orderBy("item", "text").toLocalIterator():
        words = words_of(bytes(row["text"]))
        if not words:
            continue
        total += len(words)
        if total > MAX_WORDS:
            raise ValueError(f"the items have more than {MAX_WORDS} words")
        if not blocks or size + len(words) > block_words:
            blocks.append([])
            size = 0
        blocks[-1].append(("null" if row["item"] is None else row["item"], words))
        size += len(words)
    return blocks


_SCAN = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_ARROW_SCAN = [
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
]

_automata: dict[str, ItemAutomaton] = {}


def _built(blocks: list, window: int) -> list[ItemAutomaton]:
    """The automata of broadcast blocks; a worker process builds each once and drops those of other calls."""
    named = dict(b.value for b in blocks)
    for gone in _automata.keys() - named.keys():
        del _automata[gone]
    for name, items in named.items():
        if name not in _automata:
            _automata[name] = ItemAutomaton(items, window)
    return [_automata[name] for name in named]


def _broadcast(items: DataFrame) -> list:
    """The item blocks, each with a name of its own, on all executors."""
    sc = items.sparkSession.sparkContext
    return [sc.broadcast((uuid.uuid4().hex, block)) for block in item_blocks(items)]


def _scan(blocks: list, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _built(blocks, window)
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column("text"):
                words = words_of(text.as_py())
                spans: list[tuple[int, int]] = []
                items: set[str] = set()
                for automaton in automata:
                    more, found = automaton.scan(words)
                    spans += more
                    items |= found
                out[0].append(len(words))
                out[1].append([{"start": a, "end": b} for a, b in _merged(spans)])
                out[2].append(sorted(items))
            columns = [batch.column(n) for n in batch.schema.names if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            arrays = [pa.array(x, kind) for x, (_, kind) in zip(out, _ARROW_SCAN)]
            yield pa.RecordBatch.from_arrays(columns + arrays, names + [n for n, _ in _ARROW_SCAN])

    return run


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of ``docs`` (doc_id, text, …).

    ``spans`` are the hit stretches of words [start, end); ``items`` the sorted ids of items that have a window in
    the document. A window is ``window`` successive words of an item, or all words of a shorter one. Null and empty
    texts have no words. Repeated rows each get a row; other columns are not read. Without items nothing is hit.
    """
    blocks = _broadcast(items)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *_SCAN.fields])
    return rows.mapInArrow(_scan(blocks, window), schema)


def _word_edges(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which words start and end."""
    inside = np.frombuffer(text.translate(_NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans and the white space after each."""
    starts, ends = _word_edges(text)
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = int(ends[b - 1])
        while at < len(text) and text[at] < 128 and chr(text[at]) in ".,;:!?\"')]} \t\r\n":
            at += 1
    return b"".join([*out, text[at:]]).rstrip() if out else text


def _clean(
    blocks: list, window: int, max_words: int, max_coverage: float, short_words: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _built(blocks, window)
        for batch in batches:
            texts: list[bytes | None] = []
            keep: list[bool] = []
            for value in batch.column("text"):
                text = value.as_py()
                words = words_of(text)
                spans = _merged([s for x in automata for s in x.scan(words)[0]])
                covered = sum(b - a for a, b in spans)
                whole = covered > max_coverage * len(words)
                # A span goes when it alone is long, when it is a short item as a whole (nothing else is hit by less than a
                # window), or when spans make up too much of the document.
                gone = [s for s in spans if whole or s[1] - s[0] > max_words or short_words <= s[1] - s[0] < window]
                texts.append(_cut(text, gone) if gone else text)
                keep.append(not (gone and not words_of(texts[-1])))
            place = batch.schema.get_field_index("text")
            done = batch.set_column(place, "text", pa.array(texts, pa.binary()))
            yield done.filter(pa.array(keep))

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_words: int = 9,
    max_coverage: float = 0.1,
    short_words: int = 5,
) -> DataFrame:
    """``docs`` with contaminated spans removed from ``text``; all other columns as they were.

    A span longer than ``max_words`` words is cut out, and so is an item of ``short_words`` words or more that is shorter than
    the window. If all spans of a document together exceed ``max_coverage`` of its words, all of them are, those of the
    shortest items included; elsewhere these are too common to tell anything. A document of which nothing but punctuation is left is dropped. Clean documents, null and
    empty texts stay untouched. Repeated rows are treated alike.
    """
    blocks = _broadcast(items)
    kind = docs.schema["text"].dataType
    rows = docs.withColumn("text", F.col("text").cast("binary"))
    cleaned = rows.mapInArrow(_clean(blocks, window, max_words, max_coverage, short_words), rows.schema)
    return cleaned.withColumn("text", F.col("text").cast(kind))
