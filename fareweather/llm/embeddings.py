"""Near-copies among vectors: learned binary codes, several Hamming tables, rerank.

Iterative quantisation learns rotations whose signs are balanced bits. The code is
cut into substrings, one table each; vectors that agree on a substring meet in its
bucket (by the pigeonhole principle this finds every pair that differs in fewer bits
than there are tables, and most others). There the original vectors are compared, in
double precision. A pair that meets in several buckets counts in the first only.

Equal vectors of a label are one class, so copies cost nothing. Buckets over
``block`` classes are split into blocks, and pairs of blocks go to different tasks.

Vectors that are null, zero, or hold null, NaN or infinite components link with
nothing, nor do those without a label; vectors of different length never link. Each
row of the input gives a row; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fareweather.llm import store
from fareweather.llm.components import components


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors at most from which a rotation is learned, drawn by hash;
    ``rotations`` of 64 bits, or more of as many bits as a shorter vector has components;
    ``table_bits``: length of a substring; ``block``: classes of a bucket compared
    in one task."""

    cosine: float = 0.98
    sample: int = 20_000
    rotations: int = 2
    table_bits: int = 16
    rounds: int = 30
    block: int = 4096


def _learn(x: np.ndarray, bits: int, seed: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Centre and rotation (components x bits) of the sampled unit vectors."""
    centre = x.mean(axis=0)
    v = x - centre
    _, _, axes = np.linalg.svd(v, full_matrices=False) if len(v) >= v.shape[1] else (0, 0, np.eye(v.shape[1]))
    base = axes[:bits].T
    draw = np.random.default_rng(seed).standard_normal((bits, bits))
    turn, _ = np.linalg.qr(draw)
    y = v @ base
    for _ in range(rounds):
        z = y @ turn
        left, _, right = np.linalg.svd(np.where(z >= 0, 1.0, -1.0).T @ y)
        turn = (left @ right).T
    return centre, base @ turn


def _usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _units(column: pa.Array, size: int) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _tables(size: int, s: Settings) -> int:
    return max(1, s.rotations * 64 // s.table_bits)


def _rotations(size: int, s: Settings) -> int:
    """So many that vectors of any length get as many bits: short ones need more."""
    return -(-s.rotations * 64 // min(size, 64))


def _codes(unit: np.ndarray, model: list, s: Settings) -> np.ndarray:
    """Substrings of the codes, one column for each table."""
    bits = np.concatenate([(unit - c) @ r >= 0 for c, r in model], axis=1)
    tables = _tables(unit.shape[1], s)
    out = np.zeros((len(unit), tables), np.int64)
    for t in range(tables):
        for bit in bits[:, t * s.table_bits : (t + 1) * s.table_bits].T:
            out[:, t] = out[:, t] * 2 + bit
    return out


def _entries(models: dict, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                codes = _codes(_units(part.column("vector"), size), models[int(size)], s)
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                for t in range(codes.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("rep"), part.column("n"), part.column("label"), part.column("size"),
                            pa.array(np.full(len(codes), t, np.int32)), pa.array(codes[:, t]), packed, part.column("vector"),
                        ],
                        names=["rep", "n", "label", "size", "table", "key", "code", "vector"],
                    )

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component among n."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(table: int, i: int, j: int, rows: list[tuple], s: Settings) -> Iterator[tuple]:
    """Links of the classes in one bucket (or pair of its blocks)."""
    rows.sort(key=lambda r: r[1])
    rep = np.array([r[1] for r in rows])
    n = np.array([r[2] for r in rows])
    block = np.array([r[0] for r in rows])
    codes = np.frombuffer(b"".join(r[3] for r in rows), np.int64).reshape(len(rows), -1)
    x = np.frombuffer(b"".join(r[4] for r in rows), "<f8").reshape(len(rows), -1)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    firsts, seconds = [], []
    for at in range(0, len(rows), 1024):
        a, b = np.nonzero(x[at : at + 1024] @ x.T >= s.cosine)
        a = a + at
        keep = a < b
        if i != j:
            keep &= block[a] != block[b]
        a, b = a[keep], b[keep]
        new = ~(codes[a, :table] == codes[b, :table]).any(axis=1)
        firsts.append(a[new])
        seconds.append(b[new])
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    if not len(a):
        return
    links = np.bincount(a, n[b], len(rows)) + np.bincount(b, n[a], len(rows))
    root = _roots(len(rows), a, b)
    for k in np.flatnonzero(links):
        yield int(rep[k]), int(links[k]), int(rep[root[k]])


def _links(s: Settings):
    names = ["rep", "links", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def close() -> Iterator[pa.RecordBatch]:
            found = list(_compare(key[1], key[3], key[4], rows, s)) if len(rows) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("group", "table", "key", "i", "j", "block", "rep", "n", "code", "vector")]
            for g, t, k, i, j, *row in zip(*columns):
                if (g, t, k, i, j) != key:
                    if key is not None:
                        yield from close()
                    key, rows = (g, t, k, i, j), []
                rows.append(tuple(row))
        if key is not None:
            yield from close()

    return run


def fit(vectors: DataFrame, s: Settings = Settings()) -> dict[int, list]:
    """A model for each vector length: from a bounded sample of ``vector`` rows."""
    models = {}
    for size in sorted(r[0] for r in vectors.select("size").distinct().collect()):
        sample = vectors.where(F.col("size") == size).select("rep", "vector").orderBy(F.xxhash64("rep", F.lit(8)), "rep")
        unit = _units(sample.limit(s.sample).select("vector").toArrow()["vector"], size)
        models[size] = [_learn(unit, min(size, 64), 17 + k, s.rounds) for k in range(_rotations(size, s))]
    return models


def near_copies(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept."""
    s = settings
    given = vectors.select(
        F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    usable = F.col("label").isNotNull() & _usable(F.col("embedding"))
    classes = given.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = store.written(classes.where("rep is not null"), "classes")

    def raw(batches):
        for batch in batches:
            column = batch.column("embedding")
            rows = [np.asarray(v, "<f8").tobytes() for v in column.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("n"), batch.column("label"), pa.array([len(r) // 8 for r in rows], pa.int32()), pa.array(rows, pa.binary())],
                names=["rep", "n", "label", "size", "vector"],
            )

    label = classes.schema["label"].dataType.simpleString()
    binary = store.written(
        classes.select("rep", "n", "label", "embedding").mapInArrow(raw, f"rep long, n long, label {label}, size int, vector binary"), "vectors"
    )
    models = fit(binary, s)
    entries = binary.mapInArrow(
        _entries(models, s), f"rep long, n long, label {label}, size int, table int, key long, code binary, vector binary"
    ).withColumn("group", F.xxhash64("label", "size"))
    where = ["label", "size", "table", "key"]
    large = (
        entries.groupBy(*where).count().where(F.col("count") > s.block)
        .withColumn("blocks", F.ceil(F.col("count") / s.block).cast("int")).drop("count")
    )
    blocks = F.coalesce("blocks", F.lit(1))
    placed = (
        entries.join(large, where, "left")
        .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .select("group", "table", "key", "i", "j", "block", "rep", "n", "code", "vector")
    )
    bucket = ["group", "table", "key", "i", "j"]
    found = placed.repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(_links(s), "rep long, links long, root long")
    found = store.written(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select("rep", "root"))
    known = (
        classes.join(links, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"), F.coalesce("component", "rep").alias("_root"))
    )
    joined = given.withColumn("_usable", usable).join(known, ["label", "embedding"], "left")
    root = F.when(F.col("_usable"), F.coalesce("_root", "vec_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("_usable"), F.coalesce("_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        root.alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
