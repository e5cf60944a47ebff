"""Quality of texts by a factorisation machine.

A text is described by its hashed distinct words, by figures of its structure (shares
of letters, signs, capitals and digits, word and line lengths, how often words and
lines repeat), cut into steps, and by metadata. A factorisation machine gives each
feature a weight and a short vector; the pairwise part of a score is the sum of the
products of all pairs of vectors, taken in linear time as half of the square of their
sum less the sum of their squares.

Labels are learned from a bounded sample of labelled rows (``Settings.rows``); every
row is scored, by whole text. Metadata is the number of characters that the table
states, if it has such a column (``n_chars``), and may be null. A null text is an
empty one and gets the score of its structure. Null labels teach nothing; without
labels the score is 0.5. Repeated rows count as often as they occur. An empty table
gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareweather.llm import store
from fareweather.llm.text import SIGNS, Chunk, Words, distinct, list_column, mix, pieces

_U = np.uint64


def _bytes(*codes: int) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(codes)] = True
    return mask


_BLANK = _bytes(0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_LINES = _bytes(0x0A)
_UPPER = _bytes(*range(65, 91))
_LOWER = _bytes(*range(97, 123))
_DIGIT = _bytes(*range(48, 58))
_FIRST_BYTE = np.ones(256, bool)  # of a UTF-8 character
_FIRST_BYTE[0x80:0xC0] = False
_SIGN = SIGNS & ~_BLANK
#: Signs that end words in ordinary prose.
_END = _bytes(*b".,;:?)'\"")

FIGURES = (
    "signs", "capitals", "digits", "odd ends", "signs alone", "repeated words", "top word", "repeated lines",
    "word length", "words", "words in a line", "top line", "capital words", "stated length",
)


@dataclass(frozen=True)
class Settings:
    """``rows``: labelled rows at most in the fit, drawn by hash; ``buckets`` of hashed
    words; ``steps`` of a figure; ``rank`` of the pairwise part; ``moves``: descent
    steps of the fit, each on ``batch`` rows (so small samples are gone over more often);
    ``decay`` of weights, ``pair_decay`` of vectors."""

    rows: int = 20_000
    buckets: int = 1 << 14
    steps: int = 20
    rank: int = 8
    moves: int = 600
    batch: int = 256
    rate: float = 0.02
    decay: float = 2e-4
    pair_decay: float = 2e-4
    seed: int = 13

    @property
    def features(self) -> int:
        return self.buckets + len(FIGURES) * (self.steps + 1)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    settings: Settings


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _of_texts(mask: np.ndarray, chunk: Chunk) -> np.ndarray:
    """How many bytes of each text are of a kind."""
    total = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum(mask[chunk.data], out=total[1:])
    return np.diff(total[chunk.offsets])


def _repeats(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Share of words that are repeats, and share of the most frequent one."""
    _, often, owner = distinct(words)
    texts, count = len(words.of_text) - 1, words.counts
    top = np.zeros(texts, np.int64)
    np.maximum.at(top, owner, often)
    return _share(count - np.bincount(owner, minlength=texts), count), _share(top, count)


def _figures(chunk: Chunk, stated: np.ndarray) -> np.ndarray:
    """Text x figure, each from 0 to 1; NaN where it is unknown."""
    words, lines = Words(chunk), Words(chunk, False, _LINES)
    texts, count = len(chunk), words.counts
    filled = np.diff(chunk.offsets) - _of_texts(_BLANK, chunk)
    upper, lower = _of_texts(_UPPER, chunk), _of_texts(_LOWER, chunk)
    by_word = lambda mask: np.bincount(words.text_index(), mask, texts)
    signs = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum(_SIGN[chunk.data], out=signs[1:])
    capitals = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum(_UPPER[chunk.data], out=capitals[1:])
    inside = signs[words.end] - signs[words.start]
    size = words.end - words.start
    last = chunk.data[words.end - 1] if len(words) else np.empty(0, np.uint8)
    odd = _SIGN[last] & ~_END[last] & (inside < size)
    loud = capitals[words.end] - capitals[words.start] > 1
    repeated, top = _repeats(words)
    same_lines, top_line = _repeats(lines)
    scale = lambda x, high: np.log2(1 + x) / high
    letters = _of_texts(_FIRST_BYTE, chunk)
    off = np.abs(np.log2((1 + stated) / (1 + letters)))
    return np.column_stack([
        _share(_of_texts(_SIGN, chunk), filled), _share(upper, upper + lower), _share(_of_texts(_DIGIT, chunk), filled),
        _share(by_word(odd), count), _share(by_word(inside == size), count), repeated, top, same_lines,
        _share(filled, count) / 20, scale(count, 16), scale(_share(count, lines.counts), 12), top_line,
        _share(by_word(loud), count), np.minimum(off, 1),
    ])


def _described(chunk: Chunk, stated: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text in a row, first its hashed words, and how many it has."""
    value, _, owner = distinct(Words(chunk, True, SIGNS))
    bucket = (mix(value) % _U(s.buckets)).astype(np.int64)
    key = np.unique(owner * s.buckets + bucket)
    figures = _figures(chunk, stated)
    step = np.where(np.isnan(figures), s.steps, np.floor(np.clip(figures, 0, 0.999999) * s.steps)).astype(np.int64)
    texts = len(chunk)
    own = s.buckets + np.arange(len(FIGURES)) * (s.steps + 1) + step
    feature = np.concatenate([key % s.buckets, own.ravel()])
    text = np.concatenate([key // s.buckets, np.repeat(np.arange(texts), len(FIGURES))])
    order = np.argsort(text, kind="stable")
    return feature[order].astype(np.int32), np.bincount(text, minlength=texts)


def _values(count: np.ndarray) -> np.ndarray:
    """Words of a text share the length one, each figure has a half."""
    words = count - len(FIGURES)
    each = np.repeat(1 / np.sqrt(np.maximum(words, 1)), count)
    at = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    return np.where(at < np.repeat(words, count), each, 0.5)


def _raw(feature: np.ndarray, count: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
    """Score before the logistic function, the values, and the sums of the vectors."""
    x = _values(count)
    if not len(count):
        return np.empty(0), x, np.empty((0, vectors.shape[1])), vectors[feature]
    start = np.cumsum(count) - count  # each text has its figures, so no stretch is empty
    v = vectors[feature] * x[:, None]
    sums = np.add.reduceat(v, start)
    squares = np.add.reduceat((v * v).sum(axis=1), start)
    z = bias + np.add.reduceat(weights[feature] * x, start) + 0.5 * ((sums * sums).sum(axis=1) - squares)
    return z, x, sums, v


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def learn(feature: np.ndarray, count: np.ndarray, label: np.ndarray, s: Settings) -> Model:
    """Adam steps over shuffled batches of the sample; the same rows in the same order
    give the same model."""
    draw = np.random.default_rng(s.seed)
    k = s.features
    weights, vectors, bias = np.zeros(k), draw.normal(0, 0.05, (k, s.rank)), 0.0
    if not len(label):
        return Model(0.0, weights, np.zeros_like(vectors), s)
    bias = float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    theta = np.column_stack([weights, vectors])
    fade = np.array([s.decay] + [s.pair_decay] * s.rank)
    m, v2 = np.zeros_like(theta), np.zeros_like(theta)
    start = np.cumsum(count) - count
    order, at_row = draw.permutation(len(label)), 0
    for step in range(1, s.moves + 1):
        if at_row >= len(order):
            order, at_row = draw.permutation(len(label)), 0
        rows = order[at_row : at_row + s.batch]
        at_row += s.batch
        rate = s.rate * (1 - (step - 1) / s.moves)
        n = count[rows]
        at = np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        f = feature[at]
        z, x, sums, v = _raw(f, n, bias, theta[:, 0], theta[:, 1:])
        error = (_logistic(z) - label[rows]) / len(rows)
        e = np.repeat(error, n) * x
        slope = theta * fade
        slope[:, 0] += np.bincount(f, e, k)
        own = np.repeat(sums, n, axis=0) - v
        for r in range(s.rank):
            slope[:, r + 1] += np.bincount(f, e * own[:, r], k)
        m, v2 = 0.9 * m + 0.1 * slope, 0.999 * v2 + 0.001 * slope * slope
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v2 / (1 - 0.999**step)) + 1e-8)
        bias -= rate * float(error.sum())
    return Model(bias, theta[:, 0].copy(), theta[:, 1:].copy(), s)


def _sample(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in pieces(batch):
                feature, count = _described(chunk, _stated(part), s)
                yield pa.RecordBatch.from_arrays([part.column("place"), part.column("quality"), list_column(pa.array(feature), count)], names=["place", "quality", "features"])

    return run


def _stated(part: pa.RecordBatch) -> np.ndarray:
    return part.column(part.schema.get_field_index("stated")).cast(pa.float64()).to_numpy(zero_copy_only=False)


def stated_length(docs: DataFrame) -> Column:
    """The number of characters the table states; null without such a number."""
    if "n_chars" not in docs.columns:
        return F.lit(None).cast("double")
    number = F.expr("try_cast(n_chars AS double)")
    return F.when(number >= 0, number)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from ``labels`` (doc_id, quality 0/1) of ``docs`` (doc_id, text, n_chars)."""
    s = settings
    sample = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("quality").cast("int"))
        .orderBy(F.xxhash64("doc_id", F.lit(13)), "doc_id", "quality")
        .limit(s.rows)
    )
    # Bounded by ``rows``: the labels are broadcast, the features of their texts (at most
    # ``buckets`` and the figures each) come to the driver.
    texts = docs.select("doc_id", "text", stated_length(docs).alias("stated"))
    taught = texts.join(F.broadcast(sample), "doc_id").select("quality", "text", "stated", F.xxhash64("doc_id", "text", "quality", "stated").alias("place"))
    taught = store.written(taught, "labelled").mapInArrow(_sample(s), "place long, quality int, features array<int>")
    got = taught.toArrow().sort_by("place")
    column = got["features"].combine_chunks()
    column = column if isinstance(column, pa.ListArray) else pa.concat_arrays(column.chunks)
    label = got["quality"].to_numpy().astype(float)
    return learn(column.flatten().to_numpy(), np.asarray(column.value_lengths()).astype(np.int64), label, s)


def _scores(chunk: Chunk, stated: np.ndarray, model: Model) -> np.ndarray:
    feature, count = _described(chunk, stated, model.settings)
    return _logistic(_raw(feature, count, model.bias, model.weights, model.vectors)[0])


def scorer(spark: SparkSession, model: Model):
    """A function from a text column and its stated length to the score, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, stated in batches:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string(), from_pandas=True), pa.array(stated, pa.float64(), from_pandas=True)], names=["text", "stated"]
            )
            own = [_scores(c, _stated(part), shared.value) for part, c in pieces(batch)]
            yield pd.Series(np.concatenate(own) if own else np.empty(0))

    return score
