"""Product codes of vectors; the nearest codebook entry is found in a GNAT.

A vector is cut into equal parts; each part position has a codebook, and a part's
code is the index of its nearest entry. The entries of a position stand in a
geometric near-neighbour access tree: a node's split points store, for every child,
the least and greatest distance from the split to the entries below that child. A
query whose ball around the best entry so far cannot reach that ring drops the whole
child. Rings and query distances are kept as whole numbers rounded outwards, and a
child is dropped only if its ring is strictly out of reach, so entries at an equal
distance are always seen; squared distances are integers and settle ties by index.

Training is a few rounds of a map over all vectors: each task assigns its vectors and
adds up its parts by entry, and Spark adds up the tasks' sums. Only those sums, whose
number is fixed (positions x entries), come to the driver.

Rows whose vector is null or holds null, NaN or infinite components are dropped; so
are vectors that cannot be cut like that of the smallest id (another length, or one
that is no multiple of the number of parts). Components are ``floor(scale * x)``,
held within ``limit``. Each other row is kept as it is: repeated rows count as often
as they occur and null ids stand behind all others. Fewer rows than entries give a
smaller codebook, an empty table gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareweather.llm import store

_NAMES = ["vec_id", "label", "code", "error"]


@dataclass(frozen=True)
class Settings:
    """``parts`` of a vector; ``entries`` of a codebook, at most 256; ``rounds`` of
    training; ``scale`` of a component; ``limit`` of a scaled component, so that no
    squared distance leaves 64 bits; ``splits`` of a tree node; ``leaf``: entries that
    are compared without a node; ``broadcast_labels``: labels at most whose sums are
    broadcast, beyond it they are joined by shuffle."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    limit: int = 1 << 24
    splits: int = 4
    leaf: int = 4
    broadcast_labels: int = 100_000


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        step = a[:, k, None] - b[None, :, k]
        out += step * step
    return out


def _root_below(square: np.ndarray) -> np.ndarray:
    """A whole number not above the square root."""
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    return np.maximum(root - 1, 0)


def _root_above(square: np.ndarray) -> np.ndarray:
    """A whole number not below the square root."""
    return np.sqrt(square.astype(np.float64)).astype(np.int64) + 2


class Gnat:
    """A node over some entries of a codebook; ``points`` are all entries."""

    def __init__(self, points: np.ndarray, members: np.ndarray, splits: int, leaf: int):
        self.children: list[Gnat] = []
        if len(members) <= max(leaf, splits):
            self.own, self.points = members, points[members]
            return
        chosen = [0]  # split points far from each other
        apart = _squares(points[members], points[members])
        while len(chosen) < splits:
            chosen.append(int(apart[:, chosen].min(axis=1).argmax()))
        chosen = sorted(set(chosen))
        self.own = members[chosen]
        self.points = points[self.own]
        rest = np.setdiff1d(np.arange(len(members)), chosen)
        nearest = apart[np.ix_(rest, chosen)].argmin(axis=1)
        near, far = [], []
        for j in range(len(chosen)):
            below = rest[nearest == j]
            if not len(below):
                continue
            self.children.append(Gnat(points, members[below], splits, leaf))
            ring = apart[np.ix_(chosen, below)]
            near.append(_root_below(ring.min(axis=1)))
            far.append(_root_above(ring.max(axis=1)))
        self.near, self.far = np.array(near), np.array(far)  # child x split

    def search(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        """Lower ``best`` (squared) and ``index`` of ``queries[rows]``; returns how many
        distances were taken."""
        square = _squares(queries[rows], self.points)
        taken = square.size
        own = self.own[None, :].repeat(len(rows), axis=0)
        least = square.min(axis=1)
        first = np.where(square == least[:, None], own, np.iinfo(np.int64).max).min(axis=1)
        better = (least < best[rows]) | ((least == best[rows]) & (first < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], first[better]
        if not self.children:
            return taken
        below, above = _root_below(square), _root_above(square)
        order = np.argsort([c.min() for c in self.near])
        for j in order.tolist():
            reach = _root_above(best[rows])[:, None]
            # Strictly out of reach of one split's ring: nothing below can even tie.
            out = (below > self.far[j] + reach) | (above + reach < self.near[j])
            alive = rows[~out.any(axis=1)]
            if len(alive):
                taken += self.children[j].search(queries, alive, best, index)
        return taken


class Codebooks:
    """Entries of all part positions (part x entry x component) with their trees."""

    def __init__(self, entries: np.ndarray, s: Settings):
        self.entries = entries
        self.trees = [Gnat(e, np.arange(len(e)), s.splits, s.leaf) for e in entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, vector x part."""
        parts, _, width = self.entries.shape
        code = np.zeros((len(vectors), parts), np.int64)
        error = np.zeros((len(vectors), parts), np.int64)
        rows = np.arange(len(vectors))
        for p, tree in enumerate(self.trees):
            best = np.full(len(vectors), np.iinfo(np.int64).max)
            index = np.full(len(vectors), np.iinfo(np.int64).max)
            tree.search(vectors[:, p * width : (p + 1) * width], rows, best, index)
            code[:, p], error[:, p] = index, best
        return code, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("vector"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(shared, s: Settings):
    """Of each task the number and the sums of the parts of every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        parts, entries, width = books.entries.shape
        cells = parts * entries
        total = np.zeros((cells, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch)
            code, _ = books.assign(vectors)
            cell = (code + np.arange(parts) * entries).ravel()
            total[:, 0] += np.bincount(cell, minlength=cells)
            cut = vectors.reshape(-1, width)  # sums of a batch are whole numbers below 2^53
            for k in range(width):
                total[:, k + 1] += np.bincount(cell, cut[:, k], cells).astype(np.int64)
        used = np.flatnonzero(total[:, 0])
        if len(used):
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * (width + 1)), pa.array(total[used].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(used), sums], names=["entry", "sums"])

    return run


def _codes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            code, error = books.assign(_matrix(batch))
            text = [c.tobytes().hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text), pa.array(error.sum(axis=1))], names=_NAMES)

    return run


def scaled(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(vec_id, label, vector of whole numbers) of the rows that are kept."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    usable = F.col("embedding").isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * s.scale, F.lit(float(s.limit))), F.lit(-float(s.limit)))))
    return vectors.where(F.coalesce(usable, F.lit(False))).select("vec_id", "label", whole.alias("vector"))


def train(vectors: DataFrame, s: Settings = Settings()) -> Codebooks | None:
    """Codebooks of the rows of :func:`scaled`; None without rows."""
    spark = vectors.sparkSession
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(s.entries).collect()
    if not first:
        return None
    size = len(first[0]["vector"])
    start = np.array([r["vector"] for r in first if len(r["vector"]) == size], np.int64)
    if not size or size % s.parts:
        return None
    width = size // s.parts
    entries = start.reshape(len(start), s.parts, width).transpose(1, 0, 2).copy()
    fitting = vectors.where(F.size("vector") == size).select("vector")
    for _ in range(s.rounds):
        shared = spark.sparkContext.broadcast(Codebooks(entries, s))
        partial = fitting.mapInArrow(_sums(shared, s), "entry long, sums array<long>")
        added = partial.groupBy("entry").agg(*[F.sum(F.col("sums")[k]).alias(f"c{k}") for k in range(width + 1)])
        entries = entries.copy()
        flat = entries.reshape(-1, width)
        for row in added.collect():  # positions x entries rows at most
            flat[row["entry"]] = [row[f"c{k + 1}"] // row["c0"] for k in range(width)]
    return Codebooks(entries, s)


def compress(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each row that is kept.

    ``vectors`` holds vec_id, embedding and label.
    """
    s, spark = settings, vectors.sparkSession
    whole = scaled(vectors, s)
    books = train(whole, s)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    size = books.entries.shape[0] * books.entries.shape[2]
    shared = spark.sparkContext.broadcast(books)
    label = dict(vectors.dtypes)["label"]
    key = dict(vectors.dtypes)["vec_id"]
    coded = whole.where(F.size("vector") == size).mapInArrow(_codes(shared), f"vec_id {key}, label {label}, code string, error long")
    coded = store.written(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    # A label may hold a third of all rows: where the sums are few they are broadcast,
    # else the shuffled join is left to adaptive skew handling.
    few = sums.limit(s.broadcast_labels + 1).count() <= s.broadcast_labels
    joined = coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
