"""Similarity join of word-shingle sets with a tree over count vectors.

Two texts link when the Jaccard similarity of their sets of n-word shingles reaches
a percentage. Equal sets are one class; the rest runs on one document of each.

1. A sketch of fixed size counts the shingles of all documents. It gives a global
   order, rare first; two linked sets must share one of their first few shingles
   (their prefixes), so documents meet in the buckets of these shingles only.
   Most prefix shingles stand in one document only; they are dropped by exact count
   before anything is attached to the rest.
2. Shingles are hashed into groups, and a set becomes the point of its group
   counts. In a bucket the points are indexed in an R-tree: the summed minima of a
   point and a node's upper corner bound the overlap with all below the node.
3. Of the pairs that survive, a bucket passes on a spanning forest, so a group of m
   near copies costs m-1 pairs. Count vectors of many more groups bound these once more,
   and what is left is verified on the whole sets. Where one fails,
   the buckets of its documents are gone over again with the longer count vectors:
   first a forest between what is not connected yet, at last every pair that
   is left. So no link that matters to a component is lost.

A-Z are lower-cased; words are parted by ASCII white space. A text with fewer than n
words has its whole sequence as one shingle; a null or empty text has none and links
with nothing. Repeated rows are members of one class. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareweather.llm import store
from fareweather.llm.components import components
from fareweather.llm.marks import free_name, unique_ids
from fareweather.llm.text import Words, grams, list_column, mix, pieces, ranges

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity; ``words`` of a shingle; ``groups`` of shingles
    in a count vector, ``fine_groups`` in those of the later rounds; ``slots`` of the sketch, four bytes each; ``leaf``: points in
    a leaf of the tree."""

    percent: int = 90
    words: int = 3
    groups: int = 16
    fine_groups: int = 256
    slots: int = 1 << 20
    leaf: int = 32


def sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, in a row; and how many each has."""
    values, at = grams(words, n)
    owner = np.searchsorted(words.of_text, at, "right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        whole = np.zeros(len(short), _U)
        for k in range(n - 1):
            more = words.counts[short] > k
            at_k = np.minimum(words.of_text[short] + k, len(words.hash) - 1)
            whole = np.where(more, mix(whole * _U(0xA0761D6478BD642F) + words.hash[at_k] + _U(k + 1)), whole)
        values, owner = np.concatenate([values, whole]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.bincount(owner, minlength=len(words.counts))


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    end = np.cumsum(count)
    return total[end] - total[end - count]


_FIRST = "doc_id long, n int, f1 long, f2 long, part int, counts binary"
_PART = 1 << 14
#: Counts of the sketch end here.
_MOST = (1 << 31) - 1


def _first_pass(s: Settings):
    names = ["doc_id", "n", "f1", "f2", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(s.slots, np.int64)
        for batch in batches:
            for part, chunk in pieces(batch):
                values, count = sets(Words(chunk, True), s.words)
                sketch += np.bincount((values & _U(s.slots - 1)).astype(np.int64), minlength=s.slots)
                f1, f2 = _sums(mix(values), count), _sums(mix(values ^ _U(0x5DEECE66D5DEECE6)), count)
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(count, pa.int32()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                    names=names,
                )
        for k in range(0, s.slots, _PART):
            own = sketch[k : k + _PART]
            if own.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k // _PART], pa.int32()), pa.array([own.astype("<u4").tobytes()], pa.binary())],
                    names=names,
                )

    return run


def _add_counts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, "<u4").astype(np.int64) for c in table["counts"].to_pylist())
    return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([np.minimum(total, _MOST).astype("<u4").tobytes()], pa.binary())})


def _sketch(first: DataFrame, s: Settings) -> np.ndarray:
    """The summed sketch: a fixed number of counters."""
    parts = first.where("part is not null").select("part", "counts")
    # Each task of the first pass has written a file of counts, and no task adds up
    # what very many have counted: their sums first, if there are more than a few.
    tasks = len(first.inputFiles())
    for width in [math.isqrt(tasks)] * (tasks > 64) + [1]:
        salted = parts.withColumn("turn", (F.rand(5) * width).cast("int"))
        parts = salted.groupBy("part", "turn").applyInArrow(_add_counts, "part int, counts binary")
    out = np.zeros(s.slots, np.int32)
    for r in parts.collect():
        out[r["part"] * _PART : (r["part"] + 1) * _PART] = np.frombuffer(r["counts"], "<u4")
    return out


_SECOND = "doc_id long, n int, f1 long, f2 long, tokens array<long>, point binary"


def _points(values: np.ndarray, count: np.ndarray, groups: int) -> pa.Array:
    """Count vectors: how many shingles of each text fall into each group."""
    owner = np.repeat(np.arange(len(count)), count)
    group = (mix(values ^ _U(0x2545F4914F6CDD1D)) % _U(groups)).astype(np.int64)
    points = np.bincount(owner * groups + group, minlength=len(count) * groups)
    return pa.array([p.tobytes() for p in points.astype("<u4").reshape(len(count), groups)], pa.binary())


def _fine_points(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in pieces(batch):
                values, count = sets(Words(chunk, True), s.words)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _points(values, count, s.fine_groups)], names=["doc_id", "point"])

    return run


def _second_pass(shared, s: Settings):
    """Prefix and count vector of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            for part, chunk in pieces(batch):
                values, count = sets(Words(chunk, True), s.words)
                owner = np.repeat(np.arange(len(count)), count)
                f1, f2 = _sums(mix(values), count), _sums(mix(values ^ _U(0x5DEECE66D5DEECE6)), count)
                order = np.lexsort((values, sketch[(values & _U(s.slots - 1)).astype(np.int64)], owner))
                length = np.where(count > 0, count + (-count * s.percent // 100) + 1, 0)
                take = order[ranges(np.cumsum(count) - count, length)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(count, pa.int32()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                        list_column(pa.array(values[take].view(np.int64)), length),
                        _points(values, count, s.groups),
                    ],
                    names=["doc_id", "n", "f1", "f2", "tokens", "point"],
                )

    return run


class Tree:
    """R-tree over count vectors in which pairs with enough possible overlap are found."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int):
        self.points, self.sizes = points, sizes
        order = [np.arange(len(sizes))]
        while max(len(o) for o in order) > leaf:  # cut along the widest side, again and again
            parts = []
            for o in order:
                if len(o) <= leaf:
                    parts.append(o)
                    continue
                side = points[o].max(axis=0) - points[o].min(axis=0)
                by = points[o, side.argmax()] if side.max() > 0 else sizes[o]
                o = o[np.argsort(by, kind="stable")]
                parts += [o[: len(o) // 2], o[len(o) // 2 :]]
            order = parts
        self.leaves = order
        levels = [(np.array([points[o].max(axis=0) for o in order]), np.array([sizes[o].min() for o in order]), np.array([sizes[o].max() for o in order]))]
        while len(levels[-1][1]) > 8:
            high, low_size, high_size = levels[-1]
            cut = np.arange(0, len(low_size), 8)
            levels.append((np.maximum.reduceat(high, cut), np.minimum.reduceat(low_size, cut), np.maximum.reduceat(high_size, cut)))
        self.levels = levels

    def near(self, k: int, percent: int) -> np.ndarray:
        """Points that may overlap point k enough, k among them."""
        p, n = self.points[k], self.sizes[k]

        def may(high: np.ndarray, low_size: np.ndarray, high_size: np.ndarray) -> np.ndarray:
            overlap = np.minimum(np.minimum(high, p).sum(axis=1), np.minimum(high_size, n))
            union = n + low_size - overlap
            return (overlap * 100 >= percent * union) & (low_size * percent <= 100 * n) & (high_size * 100 >= percent * n)

        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low, top = self.levels[depth]
            nodes = nodes[may(high[nodes], low[nodes], top[nodes])]
            if depth:
                last = len(self.levels[depth - 1][1])
                nodes = (nodes[:, None] * 8 + np.arange(8)).ravel()
                nodes = nodes[nodes < last]
        if not len(nodes):
            return nodes
        found = np.concatenate([self.leaves[i] for i in nodes])
        return found[may(self.points[found], self.sizes[found], self.sizes[found])]


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


_PAIRS = "a long, b long, token long, doc_id long, n int"
_PAIR_NAMES = ["a", "b", "token", "doc_id", "n"]


def _bucket(docs, sizes, points, labels, every: bool, s: Settings) -> tuple[list, bool]:
    """Pairs to verify between documents of different labels (components so far): a
    spanning forest, or ``every`` one. And whether the forest left pairs out."""
    tree = Tree(points, sizes, s.leaf)
    forest, pairs, skipped = _Forest(int(labels.max()) + 1), [], False
    for k in range(len(docs)):
        near = tree.near(k, s.percent)
        near = near[(near < k) & (labels[near] != labels[k])]
        for m in near.tolist():
            if every or forest.join(int(labels[k]), int(labels[m])):
                pairs.append((int(docs[m]), int(docs[k])))
            else:
                skipped = True
    return pairs, skipped


def _buckets(s: Settings, labelled: bool, every: bool = False):
    """Over rows sorted by token and document: pairs, and rows of buckets in which
    pairs were left out. Without labels each document stands for itself."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token = table["token"].to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        size = np.diff(edge)
        many = np.flatnonzero(size > 1)
        if not len(many):
            return
        table = table.take(pa.array(ranges(edge[many], size[many])))
        edge = np.concatenate([[0], np.cumsum(size[many])])
        docs, sizes = table["doc_id"].to_numpy(), table["n"].to_numpy().astype(np.int64)
        labels = table["label"].to_numpy() if labelled else docs
        points = np.frombuffer(b"".join(table["point"].to_pylist()), "<u4").reshape(len(docs), -1)
        pairs, again = [], []
        # Buckets of two need no tree.
        a = edge[:-1][size[many] == 2]
        overlap = np.minimum(np.minimum(points[a], points[a + 1]).sum(axis=1), np.minimum(sizes[a], sizes[a + 1]))
        a = a[(overlap * 100 >= s.percent * (sizes[a] + sizes[a + 1] - overlap)) & (labels[a] != labels[a + 1])]
        pairs += zip(docs[a].tolist(), docs[a + 1].tolist())
        for g in np.flatnonzero(size[many] > 2).tolist():
            lo, hi = int(edge[g]), int(edge[g + 1])
            own = np.unique(labels[lo:hi], return_inverse=True)[1]
            found, skipped = _bucket(docs[lo:hi], sizes[lo:hi], points[lo:hi].astype(np.int64), own, every, s)
            pairs += found
            if skipped:
                again.append((lo, hi))
        pairs = sorted(set(pairs))
        if pairs:
            first, second = zip(*pairs)
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())],
                names=_PAIR_NAMES,
            )
        for lo, hi in [] if labelled else again:
            own, none = table.slice(lo, hi - lo).combine_chunks(), pa.nulls(hi - lo, pa.int64())
            yield from pa.table([none, none, own["token"], own["doc_id"], own["n"]], names=_PAIR_NAMES).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column("token").to_numpy()
            cut = int(np.searchsorted(token, token[-1]))  # the last bucket may go on
            if held and cut == 0 and token[0] == held[-1].column("token")[0].as_py():
                held.append(batch)
                continue
            ready = [*held, batch.slice(0, cut)]
            if sum(b.num_rows for b in ready):
                yield from work(pa.Table.from_batches(ready))
            held = [batch.slice(cut)]
        if held:
            yield from work(pa.Table.from_batches(held))

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token those whose token another row has, too."""
    last: pa.RecordBatch | None = None  # the last row so far, and whether it is shared
    kept = False
    for batch in batches:
        if not batch.num_rows:
            continue
        token = batch.column("token").to_numpy()
        same = token[1:] == token[:-1]
        goes_on = last is not None and last.column("token")[0].as_py() == token[0]
        if last is not None and (kept or goes_on):
            yield last
        shared = np.concatenate([[goes_on], same]) | np.concatenate([same, [False]])
        yield batch.slice(0, batch.num_rows - 1).filter(pa.array(shared[:-1]))
        last, kept = batch.slice(batch.num_rows - 1), bool(shared[-1])
    if last is not None and kept:
        yield last


def _bounded(s: Settings):
    """Pairs with both count vectors: may the sets overlap enough?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1).astype(np.int64) for c in ("point_a", "point_b"))
            overlap = np.minimum(p, q).sum(axis=1)  # each shingle is in one group
            may = 100 * overlap >= s.percent * (p.sum(axis=1) + q.sum(axis=1) - overlap)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(may)], names=["a", "b", "may"])

    return run


def _verify(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in pieces(batch, "text_a"):
                a, na = sets(Words(chunk, True), s.words)
                other = next(iter(pieces(part, "text_b", 1 << 62)))[1]
                b, nb = sets(Words(other, True), s.words)
                both = np.concatenate([a, b])
                owner = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
                order = np.lexsort((both, owner))
                both, owner = both[order], owner[order]
                same = (both[1:] == both[:-1]) & (owner[1:] == owner[:-1])
                shared = np.bincount(owner[1:][same], minlength=len(na))
                good = 100 * shared >= s.percent * (na + nb - shared)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(good)], names=["a", "b", "good"])

    return run


#: Rows, of pairs or of buckets, for which a task of its own is worth while.
_TASK_ROWS = 1000


def _tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows in no more tasks than these are worth."""
    return df.coalesce(max(rows // _TASK_ROWS, 12))


def _verified(pairs: DataFrame, rows: int, texts: DataFrame, s: Settings) -> DataFrame:
    """Whether the sets of each pair, of about ``rows``, are near."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    whole = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return store.written(_tasks(whole, rows).mapInArrow(_verify(s), "a long, b long, good boolean"), "verified")


def near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that can be reached over links.
    """
    s, spark = settings, docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    first = store.written(docs.mapInArrow(_first_pass(s), _FIRST), "shingles")
    shared = spark.sparkContext.broadcast(_sketch(first, s))
    rows = first.where("part is null").select("doc_id", "n", "f1", "f2")
    prints = ["n", "f1", "f2"]
    classes = rows.where("n > 0 and doc_id is not null").groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    n_rows = rows.count()
    # Written, so that the last join may split a class of very many copies.
    classes = store.written(_tasks(classes, n_rows), "classes")

    second = docs.where("doc_id is not null").mapInArrow(_second_pass(shared, s), _SECOND)
    reps = classes.select("rep", F.col("f1").alias("_f1"), F.col("f2").alias("_f2"))
    one = second.join(reps, (second.doc_id == F.col("rep")) & (second.f1 == F.col("_f1")) & (second.f2 == F.col("_f2")), "left_semi")
    one = store.written(_tasks(one.select("doc_id", "n", "tokens", "point"), n_rows), "prefixes")
    narrow = one.select(F.explode("tokens").alias("token"), "doc_id").repartition("token").sortWithinPartitions("token")
    shared_ = narrow.mapInArrow(_shared, "token long, doc_id long")
    entries = shared_.join(one.select("doc_id", "n", "point"), "doc_id").select("token", "doc_id", "n", "point")
    entries = entries.repartition("token").sortWithinPartitions("token", "doc_id")
    found = store.written(entries.mapInArrow(_buckets(s, False), _PAIRS), "pairs")
    store.drop(one)
    pairs = found.where("a is not null").select("a", "b").distinct()
    n_pairs = found.where("a is not null").count()
    again = found.where("a is null").select("token", "doc_id", "n")

    needed = pairs.select("a").union(pairs.select("b")).union(again.select("doc_id")).distinct().toDF("_needed")
    texts = docs.join(needed, F.col("doc_id") == F.col("_needed"), "left_semi").dropDuplicates(["doc_id"])
    texts = store.written(_tasks(texts, 2 * n_pairs + again.count()), "texts")
    fine = store.written(texts.mapInArrow(_fine_points(s), "doc_id long, point binary"), "points")
    sides = [fine.select(F.col("doc_id").alias(side), F.col("point").alias(f"point_{side}")) for side in ("a", "b")]
    bounded = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "point_a", "point_b")
    bounded = store.written(_tasks(bounded, n_pairs).mapInArrow(_bounded(s), "a long, b long, may boolean"), "bounded")
    open_pairs = bounded.where("may").select("a", "b")
    checked = _verified(open_pairs, open_pairs.count(), texts, s)
    links = checked.where("good").select("a", "b")
    failed = bounded.where("not may").select("a", "b").union(checked.where("not good").select("a", "b"))
    roots = components(links)

    if not failed.isEmpty() and not again.isEmpty():
        bad = failed.select("a").union(failed.select("b")).distinct().toDF("doc_id")
        tokens = again.join(bad, "doc_id", "left_semi").select("token").distinct()
        open_ = again.join(tokens, "token", "left_semi")
        open_ = store.written(open_, "open")
        n_open = open_.count()
        for every in (False, True):
            # The wide points join last, so they are shuffled once a round.
            label = F.coalesce("component", "doc_id").alias("label")
            rows_ = open_.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("token", "doc_id", "n", label)
            rows_ = _tasks(rows_.join(fine, "doc_id").repartition("token"), n_open).sortWithinPartitions("token", "doc_id")
            more = rows_.mapInArrow(_buckets(s, True, every), _PAIRS).select("a", "b").distinct()
            checked = _verified(more.join(failed, ["a", "b"], "left_anti"), n_open, texts, s)
            failed = failed.union(checked.where("not good").select("a", "b"))
            # A node and its component are as good as the links that joined them.
            roots = components(roots.toDF("a", "b").union(checked.where("good").select("a", "b")))

    # What is left reads the counts, the classes and the components only.
    store.drop(found, texts, fine)
    known = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        *prints, F.coalesce("component", "rep").alias("_root")
    )
    return rows.join(known, prints, "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("_root", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each group of near copies, with all columns: the one with the
    smallest id. Where ids are missing or repeated, rows are told apart by a
    fingerprint of id and text, and equal rows are kept once."""
    unique = unique_ids(docs)
    uid = F.col("doc_id").cast("long") if unique else F.xxhash64("doc_id", "text")
    own = free_name(docs, "_uid")
    keyed = docs.withColumn(own, uid)
    found = near_copies(keyed.select(F.col(own).alias("doc_id"), "text"), settings)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(own)).distinct()
    chosen = keyed.join(kept, own, "left_semi")
    return (chosen if unique else chosen.dropDuplicates([own])).select(*docs.columns)
