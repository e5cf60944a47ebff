"""Benchmark passages in documents, also in pieces and in another order.

Greedy string tiling: shared runs of ``least`` tokens are seeds, found with rolling
Karp-Rabin fingerprints. For each document and item that share a seed, the longest
common run that is not marked yet is marked again and again (a tile), each token in
one tile at most. An item whose tokens are covered to ``coverage`` is leaked.

Tokens are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Null
or empty texts have none and match nothing. An item with fewer than ``least`` tokens
can only match as a whole; one without tokens never does. Ties between equally long
runs go to the earliest in the item, then in the document. Repeated rows and
repeated items are compared each on their own. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareweather.llm.marks import free_name, unique_ids
from fareweather.llm.text import SIGNS, Words, grams, pieces

SCHEMA = "doc_id long, item_id long, tiles int, covered int, item_tokens int, coverage double"


@dataclass(frozen=True)
class Settings:
    """``broadcast_tokens``: tokens of all items up to which they are sent to every
    task; larger item tables are joined by seed instead, with the same rows."""

    least: int = 5
    coverage: float = 0.6
    broadcast_tokens: int = 2_000_000


def tiles(item: np.ndarray, doc: np.ndarray, least: int, seeds: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in doc, length) from the given seed pairs."""
    runs: dict[int, list[list[int]]] = defaultdict(list)
    for p, t in sorted(set(seeds), key=lambda x: (x[1] - x[0], x[0])):
        if not np.array_equal(item[p : p + least], doc[t : t + least]):
            continue
        own = runs[t - p]
        if own and p <= own[-1][0] + own[-1][1] - least + 1:
            own[-1][1] = p + least - own[-1][0]
        else:
            own.append([p, least])
    heap = [(-n, p, p + shift) for shift, own in runs.items() for p, n in own]
    heapq.heapify(heap)
    in_item, in_doc, found = np.zeros(len(item), bool), set(), []
    while heap:
        n, p, t = heapq.heappop(heap)
        n = -n
        free = [not in_item[p + k] and t + k not in in_doc for k in range(n)]
        if all(free):
            found.append((p, t, n))
            in_item[p : p + n] = True
            in_doc.update(range(t, t + n))
            if in_item.all():
                break
            continue
        k = 0
        while k < n:  # what is left of the run between marked tokens
            if free[k]:
                e = k
                while e < n and free[e]:
                    e += 1
                if e - k >= least:
                    heapq.heappush(heap, (k - e, p + k, t + k))
                k = e
            k += 1
    return found


def _judge(doc_id, doc: np.ndarray, pairs: dict, items: dict, s: Settings) -> Iterator[tuple]:
    for item_id, seeds in sorted(pairs.items(), key=lambda x: str(x[0])):
        item = items[item_id]
        n = min(s.least, len(item))
        found = tiles(item, doc, n, seeds)
        covered = sum(x[2] for x in found)
        if covered >= s.coverage * len(item):
            yield doc_id, item_id[0], len(found), covered, len(item), covered / len(item)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    names = ["doc_id", "item_id", "tiles", "covered", "item_tokens", "coverage"]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


class _Index:
    """Seeds of items: sorted fingerprints of each length and where they stand."""

    def __init__(self, items: dict, least: int):
        self.items = items
        self.by_length: dict[int, tuple] = {}
        lists: dict[int, list] = defaultdict(list)
        for key, tokens in items.items():
            if len(tokens):
                lists[min(least, len(tokens))].append((key, tokens))
        for n, own in lists.items():
            seeds, where = [], []
            for key, tokens in own:
                for p, g in enumerate(_seed_values(tokens, n)):
                    seeds.append(g)
                    where.append((key, p))
            order = np.argsort(np.array(seeds, np.uint64), kind="stable")
            values = np.array(seeds, np.uint64)[order]
            sieve = np.zeros(1 << 20, bool)
            sieve[values & np.uint64(0xFFFFF)] = True
            self.by_length[n] = values, [where[i] for i in order], sieve

    def judge(self, words: Words, ids: list, s: Settings) -> Iterator[tuple]:
        pairs: dict[int, dict] = defaultdict(lambda: defaultdict(list))
        for n, (values, where, sieve) in self.by_length.items():
            g, at = grams(words, n)
            maybe = np.flatnonzero(sieve[g & np.uint64(0xFFFFF)])
            low = np.searchsorted(values, g[maybe])
            high = np.searchsorted(values, g[maybe], "right")
            hit = high > low
            word = at[maybe[hit]]
            text = np.searchsorted(words.of_text, word, "right") - 1
            for w, t, a, b in zip(word.tolist(), text.tolist(), low[hit].tolist(), high[hit].tolist()):
                for k in range(a, b):
                    key, p = where[k]
                    pairs[t][key].append((p, w - int(words.of_text[t])))
        for t in sorted(pairs):
            doc = words.hash[words.of_text[t] : words.of_text[t + 1]]
            yield from _judge(ids[t], doc, pairs[t], self.items, s)


class _Tokens:
    """A text given as its token fingerprints, in the shape ``grams`` takes."""

    def __init__(self, tokens: np.ndarray):
        self.hash, self.of_text, self.counts = tokens, np.array([0, len(tokens)]), np.array([len(tokens)])


def _seed_values(tokens: np.ndarray, n: int) -> np.ndarray:
    return grams(_Tokens(tokens), n)[0]


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item id, tokens) of benchmark rows; copies of an item are told apart."""
    for batch in batches:
        for part, chunk in pieces(batch):
            words = Words(chunk, True, SIGNS)
            offsets = pa.array(words.of_text.astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(words.hash.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("item_id"), lists], names=["item_id", "tokens"])


def leaks(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pairs of a document and a benchmark item that it covers.

    ``docs`` needs doc_id and text, ``items`` item_id and text. One row per row of
    ``docs`` and leaked item.
    """
    s, spark = settings, docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    tokens = items.mapInArrow(_tokens_of, "item_id long, tokens array<long>")
    total = tokens.agg(F.sum(F.size("tokens"))).first()[0] or 0
    if total <= s.broadcast_tokens:
        rows = tokens.where(F.size("tokens") > 0).collect()
        held = {(r["item_id"], i): np.array(r["tokens"], np.int64).view(np.uint64) for i, r in enumerate(rows)}
        shared = spark.sparkContext.broadcast(held)

        def run(batches):
            index = _Index(shared.value, s.least)
            for batch in batches:
                for part, chunk in pieces(batch):
                    found = list(index.judge(Words(chunk, True, SIGNS), part.column("doc_id").to_pylist(), s))
                    if found:
                        yield _rows(found)

        return docs.mapInArrow(run, SCHEMA)
    return _joined(docs, tokens, s)


def _joined(docs: DataFrame, tokens: DataFrame, s: Settings) -> DataFrame:
    """As ``leaks`` for an item table of any size: seeds meet in a shuffled join."""
    lengths = [r[0] for r in tokens.select(F.least(F.size("tokens"), F.lit(s.least))).distinct().collect() if r[0] > 0]
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    items = tokens.where(F.size("tokens") > 0).withColumn("_item", F.monotonically_increasing_id())

    def doc_seeds(batches):
        for batch in batches:
            for part, chunk in pieces(batch):
                words = Words(chunk, True, SIGNS)
                rows = part.column("_row").to_numpy()
                for n in lengths:
                    g, at = grams(words, n)
                    owner = rows[np.searchsorted(words.of_text, at, "right") - 1]
                    both = np.unique(np.rec.fromarrays([g, owner]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(both.f0.view(np.int64)), pa.array(both.f1), pa.array(np.full(len(both), n, np.int32))],
                        names=["seed", "_row", "n"],
                    )

    def item_seeds(batches):
        for batch in batches:
            for r in batch.to_pylist():
                own = np.array(r["tokens"], np.int64).view(np.uint64)
                n = min(s.least, len(own))
                g = np.unique(_seed_values(own, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(np.full(len(g), r["_item"])), pa.array(np.full(len(g), n, np.int32))],
                    names=["seed", "_item", "n"],
                )

    left = docs.mapInArrow(doc_seeds, "seed long, _row long, n int")
    right = items.select("_item", "tokens").mapInArrow(item_seeds, "seed long, _item long, n int")
    pairs = left.join(right, ["seed", "n"]).select("_row", "_item").distinct()
    both = pairs.join(docs, "_row").join(items, "_item")

    def judge(batches):
        for batch in batches:
            for part, chunk in pieces(batch):
                words, rows = Words(chunk, True, SIGNS), part.select(["doc_id", "item_id", "tokens"]).to_pylist()
                found = []
                for t, r in enumerate(rows):
                    item = np.array(r["tokens"], np.int64).view(np.uint64)
                    doc = words.hash[words.of_text[t] : words.of_text[t + 1]]
                    n, where = min(s.least, len(item)), defaultdict(list)
                    for p, g in enumerate(_seed_values(item, n).tolist()):
                        where[g].append(p)
                    seeds = [(p, i) for i, g in enumerate(_seed_values(doc, n).tolist()) for p in where.get(g, ())]
                    key = (r["item_id"], 0)
                    found += _judge(r["doc_id"], doc, {key: seeds}, {key: item}, s)
                yield _rows(found)

    return both.select("doc_id", "text", "item_id", "tokens").mapInArrow(judge, SCHEMA)


def clean(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that cover no item, with all their columns.

    Where ids are missing or repeated, rows are told apart by a fingerprint of id and
    text: a leaked row without an id goes, a clean one with a leaked one's id stays."""
    uid = F.col("doc_id").cast("long") if unique_ids(docs) else F.xxhash64("doc_id", "text")
    own = free_name(docs, "_uid")
    keyed = docs.withColumn(own, uid)
    found = leaks(keyed.select(F.col(own).alias("doc_id"), "text"), items, settings)
    leaked = found.select(F.col("doc_id").alias(own)).distinct()
    return keyed.join(leaked, own, "left_anti").select(*docs.columns)
