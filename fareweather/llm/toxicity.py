"""Toxicity with a classifier that must not care which group is named.

A logistic model over the distinct words of a text and their beginnings. For
labelled texts that name a group, a twin is made in which each identity term is
replaced by another of its kind; the fit penalises the squared change of the score
between the two, so a term cannot carry weight of its own.

Labels are learned from a bounded sample of labelled rows (``Settings.rows``); all
rows are scored, by whole text. A null or empty text gets the score of a text
without known words. Null labels teach nothing; without labels the score is 0.5 and
``predicted`` 1. Repeated rows count as often as they occur. Extra columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fareweather.llm import store
from fareweather.llm.text import SIGNS, Chunk, Words, list_column, mix, pieces, stretch

#: Terms that name groups, by kind. Each is swapped for the next.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"), ("her", "his"),
    ("mother", "father"), ("wife", "husband"), ("female", "male"), ("lesbian", "gay", "straight", "bisexual", "transgender"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("immigrants", "natives", "refugees", "citizens"),
    ("africans", "europeans", "americans", "asians"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


@dataclass(frozen=True)
class Settings:
    """``rows``: labelled rows at most in the fit, drawn by hash; ``least``: sampled
    texts a word must stand in; ``signal``: how many standard deviations its share of
    toxic texts must lie off the common one, else the word is left out, so that long
    texts do not gather noise; ``features``: kept at most; ``beginnings``: lengths in bytes of word beginnings;
    ``penalty``: of squared score changes; ``decay``: of squared weights."""

    rows: int = 20_000
    least: int = 3
    features: int = 200_000
    signal: float = 3.5
    beginnings: tuple[int, ...] = (4, 5, 6)
    penalty: float = 5.0
    decay: float = 1.0
    steps: int = 150
    terms: tuple[tuple[str, ...], ...] = field(default=IDENTITY_TERMS)


@dataclass(frozen=True)
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float
    settings: Settings


def _features(words: Words, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text in a row, and how many each text has."""
    index = words.text_index()
    size = words.end - words.start
    parts, owners = [words.hash], [index]
    for n in settings.beginnings:
        long = size > n
        start = words.start[long]
        parts.append(mix(stretch(words.prefix, start, start + n) + np.uint64(n)))
        owners.append(index[long])
    values, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], np.bincount(owner[keep], minlength=len(words.of_text) - 1)


def _chunk(texts: list[bytes]) -> Chunk:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return Chunk(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def _swapped(text: str, other: dict[str, str]) -> str | None:
    """The text with each identity term replaced; None if it names no group."""
    import re

    hit = False

    def turn(m: re.Match) -> str:
        nonlocal hit
        new = other.get(m[0].lower())
        hit |= new is not None
        return m[0] if new is None else new

    out = re.sub(r"\w+", turn, text)
    return out if hit else None


def _own_and_changed(part: pa.RecordBatch, chunk: Chunk, other: dict[str, str], settings: Settings):
    """Features of each text, and those that a text and its twin do not share: +1 for
    the text's, -1 for the twin's."""
    texts = ["" if t is None else t for t in part.column("text").to_pylist()]
    values, count = _features(Words(chunk, True, SIGNS), settings)
    owner = np.repeat(np.arange(len(texts)), count)
    twins = [(i, s) for i, t in enumerate(texts) if (s := _swapped(t, other)) is not None]
    if not twins:
        none = np.empty(0, np.int64)
        return values, owner, none.astype(np.uint64), none, none.astype(np.int8)
    index = np.array([i for i, _ in twins])
    twin, own = _features(Words(_chunk([s.encode() for _, s in twins]), True, SIGNS), settings)
    plain = np.isin(owner, index)
    change = np.concatenate([values[plain], twin])
    changed = np.concatenate([owner[plain], np.repeat(index, own)])
    sign = np.concatenate([np.ones(int(plain.sum()), np.int8), -np.ones(len(twin), np.int8)])
    order = np.lexsort((change, changed))
    change, changed, sign = change[order], changed[order], sign[order]
    pair = (change[1:] == change[:-1]) & (changed[1:] == changed[:-1])
    alone = ~(np.append(pair, False) | np.insert(pair, 0, False))
    return values, owner, change[alone], changed[alone], sign[alone]


def _count_features(settings: Settings):
    """(feature, texts with it, toxic ones, whether a swap changes it); feature null
    holds the numbers of all texts."""
    other = _swaps(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in pieces(batch):
                toxic = part.column("toxic").to_numpy().astype(np.int64)
                values, owner, change, _, _ = _own_and_changed(part, chunk, other, settings)
                known, back = np.unique(np.concatenate([values, change]), return_inverse=True)
                seen = np.bincount(back[: len(values)], minlength=len(known))
                bad = np.bincount(back[: len(values)], toxic[owner], len(known)).astype(np.int64)
                moved = np.bincount(back[len(values) :], minlength=len(known)) > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(known.view(np.int64)), pa.nulls(1, pa.int64())]),
                        pa.array(np.append(seen, len(toxic))), pa.array(np.append(bad, toxic.sum())), pa.array(np.append(moved, False)),
                    ],
                    names=["feature", "seen", "bad", "moved"],
                )

    return run


def _sample_features(shared, settings: Settings):
    """Of each text the features that were chosen, and those a swap changes."""
    other = _swaps(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.value
        for batch in batches:
            for part, chunk in pieces(batch):
                values, owner, change, changed, sign = _own_and_changed(part, chunk, other, settings)
                keep, moved = np.isin(values, chosen), np.isin(change, chosen)
                rows = part.num_rows
                count = np.bincount(owner[keep], minlength=rows)
                own = np.bincount(changed[moved], minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("toxic"),
                        list_column(pa.array(np.searchsorted(chosen, values[keep]).astype(np.int32)), count),
                        list_column(pa.array(np.searchsorted(chosen, change[moved]).astype(np.int32)), own),
                        list_column(pa.array(sign[moved].astype(np.int32)), own),
                    ],
                    names=["toxic", "features", "change", "sign"],
                )

    return run


def _swaps(settings: Settings) -> dict[str, str]:
    return {t: kind[(i + 1) % len(kind)] for kind in settings.terms for i, t in enumerate(kind)}


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from ``labels`` (doc_id, toxic 0/1) of ``docs`` (doc_id, text)."""
    s, spark = settings, docs.sparkSession
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("toxic").cast("int"))
        .orderBy(F.xxhash64("doc_id", F.lit(10)), "doc_id", "toxic")
        .limit(s.rows)
    )
    # Bounded by ``rows``: the labels are broadcast; of features only those that tell
    # something, at most ``features`` of them, come to the driver.
    taught = store.written(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text"), "labelled")
    counted = taught.mapInArrow(_count_features(s), "feature long, seen long, bad long, moved boolean")
    counted = counted.groupBy("feature").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"), F.max("moved").alias("moved"))
    counted = store.written(counted, "features")
    whole = counted.where("feature is null").first()
    none = np.empty(0, np.uint64)
    if whole is None or not whole["seen"]:
        return Model(none, np.empty(0), 0.0, s)
    share = whole["bad"] / whole["seen"]
    off = F.abs(F.col("bad") - share * F.col("seen"))
    far = off / F.sqrt(F.greatest("seen", F.lit(1)))
    telling = (F.col("seen") >= s.least) & (off >= s.signal * F.sqrt(F.col("seen") * max(share * (1 - share), 1e-12)))
    rows = (
        counted.where("feature is not null").where(F.col("moved") | telling)
        .orderBy(F.desc("moved"), F.desc(far), "feature").limit(s.features).select("feature").collect()
    )
    features = np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(features)
    got = taught.mapInArrow(
        _sample_features(shared, s), "toxic int, features array<int>, change array<int>, sign array<int>"
    ).toArrow()

    def lists(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = got[name].combine_chunks()
        column = column if isinstance(column, pa.ListArray) else pa.concat_arrays(column.chunks)
        return column.flatten().to_numpy(), np.asarray(column.value_lengths())

    label = got["toxic"].to_numpy().astype(float)
    column, count = lists("features")
    owner = np.repeat(np.arange(len(label)), count)
    d_column, count = lists("change")
    d_owner, d_value = np.repeat(np.arange(len(label)), count), lists("sign")[0].astype(float)

    n, k = len(label), len(features)
    w, b = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, s.steps + 1):
        z = b + np.bincount(owner, w[column], n)
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - label
        slope = np.bincount(column, error[owner], k) + s.decay * w
        if len(d_owner):
            moved = np.bincount(d_owner, w[d_column] * d_value, n)
            slope = slope + 2 * s.penalty * np.bincount(d_column, moved[d_owner] * d_value, k)
        g = np.append(slope, error.sum()) / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - float(move[-1])
    return Model(features, w, b, s)


def _scores(words: Words, model: Model) -> np.ndarray:
    values, count = _features(words, model.settings)
    z = np.full(len(count), model.bias)
    if len(model.features) and len(values):
        at = np.minimum(np.searchsorted(model.features, values), len(model.features) - 1)
        own = np.where(model.features[at] == values, model.weights[at], 0.0)
        z += np.bincount(np.repeat(np.arange(len(count)), count), own, len(count))
    return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    return _scores(Words(_chunk([(t or "").encode() for t in texts]), True, SIGNS), model)


def scorer(spark: SparkSession, model: Model):
    """A function from a text column to its score, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            column = pa.array(texts, pa.string(), from_pandas=True)
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            own = [_scores(Words(c, True, SIGNS), shared.value) for _, c in pieces(batch)]
            yield pd.Series(np.concatenate(own) if own else np.empty(0))

    return score
