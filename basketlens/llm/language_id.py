"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams, of all lengths 1 to ``order``, present in both, divided
by the geometric mean of the numbers in each (blended spectrum, presence). Texts are lower-cased and
every run of other characters than letters is one space; n-grams are hashed to 18 bits, so every script is treated
alike. A sample of bounded size per language is the training set, a part of it the landmarks. Nyström features of a text
are its kernels with the landmarks times the inverse square root of the landmarks' own kernel matrix; on
them one ridge regression per language, against the rest, is solved, from sums that tasks make over the sample. A batch of
texts is scored by two matrix products: presence matrix times landmark matrix, then times the coefficients.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.plans.workspace import written

UNKNOWN = "und"
GRAM_BITS = 18
ORDER = 3
# Bound of the sample that the model is fitted on: rows per language. Every language is learned.
ROWS_PER_LANGUAGE = 300
# Landmarks in all, or per language where that is more.
LANDMARKS = 128
LANDMARKS_PER_LANGUAGE = 2
RIDGE = 1e-3
# Parts that the sample is summed in; fixed, so that rounding does not depend on the cluster.
_SUM_PARTS = 32
# Landmarks in one matrix product, a multiple of eight.
_LANDMARK_BLOCK = 128
# Texts in one matrix product, and characters whose n-grams are hashed at a time.
_BATCH = 256
_PART = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Of each code point the lower-case letter, or a space if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _normal(text: str) -> np.ndarray:
    """Code points of the normalised text, empty without letters."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    space = codes == 32
    if space.all():
        return codes[:0]
    again = np.zeros(len(codes), bool)
    again[1:] = space[1:] & space[:-1]
    inner = codes[~again]
    inner = inner[int(inner[0] == 32) : len(inner) - int(inner[-1] == 32)]
    return np.concatenate((np.uint32([32]), inner, np.uint32([32]))).astype(np.uint64)


class Presence:
    """Finds the hashed n-grams present in a text."""

    def __init__(self, order: int) -> None:
        self.order = order
        self.seen = np.zeros(1 << GRAM_BITS, bool)

    def grams(self, text: str | None) -> np.ndarray | None:
        """Sorted n-gram numbers of a whole text; None without letters."""
        codes = _normal(text) if text else np.zeros(0, np.uint64)
        if not len(codes):
            return None
        for start in range(0, len(codes), _PART):
            part = codes[start : start + _PART + self.order - 1]
            code = np.zeros(len(part), np.uint64)
            for n in range(self.order):
                # Polynomial over the last n + 1 letters, mixed and cut to its high bits.
                code = code[: len(part) - n] * np.uint64(1_114_127) + part[n:] + np.uint64(1)
                mixed = code * np.uint64(0x9E3779B97F4A7C15)
                self.seen[(mixed >> np.uint64(64 - GRAM_BITS)).astype(np.int64)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


@dataclass
class LanguageModel:
    """Landmark n-grams, a bit each, and coefficients; a few megabytes for some hundred languages, whatever the corpus."""

    languages: list[str]
    order: int
    column: np.ndarray  # n-gram number -> column of the landmark matrix, or -1
    landmarks: np.ndarray  # columns x landmarks, 0/1, eight landmarks to a byte
    norms: np.ndarray  # square root of each landmark's number of n-grams
    weights: np.ndarray  # landmarks x languages

    @classmethod
    def around(cls, languages: list[str], order: int, marks: list[np.ndarray]) -> LanguageModel:
        """A model of these landmarks, given by their n-grams, still without coefficients."""
        column = np.full(1 << GRAM_BITS, -1, np.int32)
        used = np.unique(np.concatenate([np.zeros(0, np.int32), *marks]))
        column[used] = np.arange(len(used))
        bits = np.zeros((len(used), -(-len(marks) // 8)), np.uint8)
        for j, grams in enumerate(marks):
            bits[column[grams], j // 8] |= np.uint8(128 >> j % 8)
        norms = np.sqrt(np.array([len(g) for g in marks], np.float64))
        return cls(languages, order, column, bits, norms, np.zeros((len(marks), len(languages))))

    def __post_init__(self) -> None:
        self._block: tuple[int, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_block": None}

    def _landmark_block(self, start: int) -> np.ndarray:
        """Columns x landmarks from ``start`` on, as numbers; the last block asked for is kept."""
        if self._block is None or self._block[0] != start:
            bits = self.landmarks[:, start // 8 : (start + _LANDMARK_BLOCK) // 8]
            n = min(_LANDMARK_BLOCK, len(self.norms) - start)
            self._block = start, np.unpackbits(bits, axis=1, count=n).astype(np.float32)
        return self._block[1]

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel of each text, given by its n-grams, with each landmark."""
        present = np.zeros((len(grams), self.landmarks.shape[0]), np.float32)
        for row, found in zip(present, grams):
            places = self.column[found]
            row[places[places >= 0]] = 1
        sizes = np.sqrt(np.array([max(1, len(g)) for g in grams], np.float64))
        shared = [present @ self._landmark_block(at) for at in range(0, len(self.norms), _LANDMARK_BLOCK)]
        return np.concatenate(shared, axis=1) / (sizes[:, None] * self.norms)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. The score is the best class's regression value, cut to [0, 1]; equal
        values are settled by the order of the names. Texts without letters are ``und`` with score 0."""
        finder = Presence(self.order)
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return langs, scores
        for start in range(0, len(texts), _BATCH):
            grams = [finder.grams(t) for t in texts[start : start + _BATCH]]
            rows = [i for i, g in enumerate(grams) if g is not None]
            if not rows:
                continue
            values = self.kernel([grams[i] for i in rows]) @ self.weights
            best = values.argmax(axis=1)
            for i, b, v in zip(rows, best, values[np.arange(len(rows)), best]):
                langs[start + i], scores[start + i] = self.languages[b], min(1.0, max(0.0, v))
        return langs, scores


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` rows (lang, mark, text) of each language.

    Rows are hashed into slots per language, and the row with the smallest hash of a slot is taken, so no task
    sees more of a language than one row per slot, however frequent it is. The hash is of id, language and text: rows
    without an id are told apart, and rows with the same hash are the same.
    """
    mark = F.xxhash64("doc_id", "lang", "text")
    slot = F.pmod(F.shiftright("mark", 16), F.lit(per_language)).alias("slot")
    marked = labelled.select("lang", "text", mark.alias("mark"))
    chosen = marked.groupBy("lang", slot).agg(F.min("mark").alias("mark")).select("lang", "mark")
    return marked.join(chosen, ["lang", "mark"], "left_semi").dropDuplicates(["lang", "mark"])


def _grams(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Presence(order)
        for batch in batches:
            found = [finder.grams(t.as_py()) for t in batch.column("text")]
            keep = [i for i, g in enumerate(found) if g is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang").take(pa.array(keep, pa.int64())),
                    batch.column("mark").take(pa.array(keep, pa.int64())),
                    pa.array([found[i].astype("<i4").tobytes() for i in keep], pa.binary()),
                ],
                ["lang", "mark", "grams"],
            )

    return run


def _unpacked(grams: bytes) -> np.ndarray:
    return np.frombuffer(grams, "<i4")


def _sums(sample: DataFrame, model: LanguageModel, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the sample's weighted features with each other, and their sums per language.

    Rows weigh so that each language counts the same, and 1 in all. Tasks add; the driver holds two sums at a time.
    """
    counts = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = {lang: i for i, lang in enumerate(model.languages)}
    held = sample.sparkSession.sparkContext.broadcast((model, root, counts, place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, root, counts, place = held.value
        products = np.zeros((root.shape[1], root.shape[1]))
        targets = np.zeros((root.shape[1], len(place)))
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                rows = batch.slice(start, _BATCH)
                features = model.kernel([_unpacked(g) for g in rows.column("grams").to_pylist()]) @ root
                langs = rows.column("lang").to_pylist()
                weighted = features * (1 / (len(place) * np.array([counts[lang] for lang in langs])))[:, None]
                products += features.T @ weighted
                np.add.at(targets.T, [place[lang] for lang in langs], weighted)
        values = [[TaskContext.get().partitionId()], [products.tobytes()], [targets.tobytes()]]
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["part", "products", "targets"])

    spread = sample.repartition(_SUM_PARTS, "mark").sortWithinPartitions("mark", "lang")
    parts = written(spread.mapInArrow(run, "part int, products binary, targets binary"), "language-sums")
    products, targets = np.zeros((root.shape[1], root.shape[1])), np.zeros((root.shape[1], len(place)))
    for row in parts.orderBy("part").toLocalIterator():
        products += np.frombuffer(row["products"]).reshape(products.shape)
        targets += np.frombuffer(row["targets"]).reshape(targets.shape)
    held.unpersist()
    return products, targets


def fit(
    labelled: DataFrame,
    per_language: int = ROWS_PER_LANGUAGE,
    n_landmarks: int = LANDMARKS,
    order: int = ORDER,
    ridge: float = RIDGE,
) -> LanguageModel:
    """Fit on at most ``per_language`` rows of each language of ``labelled`` (doc_id, text, lang).

    Every language with a text is learned. Rows with a null text or lang, and texts without letters, are left out. Without
    any row the model knows no language and says ``und``. There are ``n_landmarks`` landmarks, or
    LANDMARKS_PER_LANGUAGE for each language where that is more. The driver gets the landmarks' n-gram numbers (at most 2^18
    of four bytes for each) and sums of landmarks x (landmarks + languages) numbers, no other row.
    """
    rows = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    found = _sample(rows, per_language).select("lang", "mark", "text")
    sample = written(found.mapInArrow(_grams(order), "lang string, mark long, grams binary"), "language-sample")
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not languages:
        return LanguageModel.around([], order, [])
    # Landmarks: the languages in turn. A language has at most per_language rows here.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("mark")).alias("turn")
    wanted = max(n_landmarks, LANDMARKS_PER_LANGUAGE * len(languages))
    first = sample.select("lang", "mark", turn).where(F.col("turn") <= wanted).orderBy("turn", "lang").limit(wanted)
    marks = sample.join(F.broadcast(first), ["lang", "mark"]).orderBy("turn", "lang").select("grams").collect()
    model = LanguageModel.around(languages, order, [_unpacked(r["grams"]) for r in marks])
    own = np.concatenate(
        [model.kernel([_unpacked(r["grams"]) for r in marks[i : i + _BATCH]]) for i in range(0, len(marks), _BATCH)]
    )
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    solid = values > 1e-8 * values.max()
    root = vectors[:, solid] / np.sqrt(values[solid])
    products, targets = _sums(sample, model, root)
    model.weights = root @ np.linalg.solve(products + ridge * np.eye(len(products)), targets)
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (text, …) with ``lang_pred`` and ``score``; only ``text`` is looked at, and all of it.

    A null text, or one without letters, is ``und`` with score 0. All rows and all other columns stay;
    columns of these two names are replaced.
    """
    own = docs.drop("lang_pred", "score")
    held = own.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = held.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*own.schema.fields, *added])
    return own.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is held out of the training: crc32 of its id as text is divisible by ``folds``; rows
    without an id are held out."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % folds == 0, F.lit(True))
