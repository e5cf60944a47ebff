"""Ranked lexical search with range-maximum sparse tables on posting lists.

Documents are searched in blocks. In a block each term of the queries has a posting
list by document, with the impact (the term's whole contribution to the score) of
every posting, and a sparse table that gives the largest impact of any stretch of the
list in two look-ups. An interval of documents is bounded by the sum of these range
maxima over a query's terms. Intervals are taken best bound first; one is split at
the document of its largest impact, which is scored, and both sides are bounded anew.
Intervals of a few documents (``leaf``) are scored as a whole. It ends when no bound
left can reach the places held; the places carry over from block to block of a task.

Documents are tokenised once, into a table of their length and the terms of the
queries they hold; counts of documents, terms and postings are taken over all rows.
Queries whose terms do not fit ``terms`` are worked off in several turns, each over
the whole table of documents.

A term is a maximal run of letters, digits and all characters beyond ASCII, A-Z
lower-cased; terms are told apart by 64-bit fingerprints. A null text has none. Rows of
equal ``item_id`` are one query with the terms of all, each once; a query without
terms, or one that no document meets, gives no rows. Repeated rows and ids of
documents are documents of their own; those without an id rank after all others of
their score. Empty tables give no rows. Extra columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fareweather.llm import store
from fareweather.llm.text import SIGNS, Words, distinct, list_column, pieces, ranges

_U = np.uint64
_LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Settings:
    """``best``: places of a query; ``terms``: (query, term) pairs of a turn, about;
    ``postings`` of a block, about; ``leaf``: documents scored without a split;
    ``turns``: first groups in which a query's places are merged."""

    best: int = 50
    terms: int = 1_000_000
    postings: int = 1 << 19
    leaf: int = 128
    turns: int = 64


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, chunk in pieces(batch):
            value, _, owner = distinct(Words(chunk, True, SIGNS))
            yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(owner)), pa.array(value.view(np.int64))], names=["item", "term"])


def _postings(shared):
    """Length of each text in terms, and which of the sought terms it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = shared.value
        for batch in batches:
            for part, chunk in pieces(batch):
                words = Words(chunk, True, SIGNS)
                at = np.minimum(np.searchsorted(sought, words.hash), len(sought) - 1)
                hit = sought[at] == words.hash
                key = words.text_index()[hit] * len(sought) + at[hit]
                key, often = np.unique(key, return_counts=True)
                count = np.bincount(key // len(sought), minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(words.counts.astype(np.int64)),
                        list_column(pa.array((key % len(sought)).astype(np.int32)), count), list_column(pa.array(often.astype(np.int64)), count),
                    ],
                    names=["doc_id", "n", "terms", "often"],
                )

    return run


class Lists:
    """Posting lists of a block, one after another, with their sparse tables.

    ``term`` and ``doc`` (place in the block) of each posting are sorted by term, then
    document; ``impact`` is the posting's share of a score.
    """

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        order = np.lexsort((doc, term))
        self.doc, self.impact, self.docs = doc[order], impact[order], docs
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        self.key = term[order].astype(np.int64) * (docs + 1) + self.doc
        # Level k of a sparse table: the posting with the largest impact of the 2^k from here.
        longest = int(np.diff(self.start).max(initial=0))
        self.levels = [np.arange(len(self.doc))]
        while 2 << (len(self.levels) - 1) <= longest:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            left, right = last[:-half], last[half:]
            best = last.copy()
            best[:-half] = np.where(self.impact[right] > self.impact[left], right, left)
            self.levels.append(best)

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Posting with the largest impact of each stretch a..b-1 (not empty) of a list."""
        size = b - a
        level = np.frexp(size.astype(np.float64))[1] - 1
        left, right = np.empty_like(a), np.empty_like(a)
        for k in np.unique(level).tolist():
            own = level == k
            left[own] = self.levels[k][a[own]]
            right[own] = self.levels[k][b[own] - (1 << k)]
        return np.where(self.impact[right] > self.impact[left], right, left)


class Search:
    """Best-first search of one query in a block; keeps the places found so far."""

    def __init__(self, lists: Lists, ids: np.ndarray, terms: np.ndarray, s: Settings):
        self.lists, self.ids, self.s = lists, ids, s
        begin, end = lists.start[terms], lists.start[terms + 1]
        self.terms = terms[end > begin]
        self.scored = 0

    def _bounded(self, lo: int, hi: int, terms, a, b):
        """The interval with its bound and the document of its largest impact; its
        terms without postings are left out."""
        some = b > a
        if lo >= hi or not some.any():
            return None
        terms, a, b = terms[some], a[some], b[some]
        top = self.lists.largest(a, b)
        impact = self.lists.impact[top]
        return int(impact.sum()), lo, hi, terms, a, b, int(self.lists.doc[top[impact.argmax()]])

    def _scores(self, interval) -> tuple[np.ndarray, np.ndarray]:
        """All documents of a small interval that hold a term, with their scores."""
        _, lo, hi, _, a, b, _ = interval
        at = ranges(a, b - a)
        doc, impact = self.lists.doc[at] - lo, self.lists.impact[at]
        held = np.flatnonzero(np.bincount(doc, minlength=hi - lo))
        score = np.zeros(hi - lo, np.int64)
        np.add.at(score, doc, impact)
        self.scored += len(held)
        return held + lo, score[held]

    def run(self, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """``best``: (score, id), best first, at most ``s.best``; returns the new ones."""
        import heapq

        lists, s = self.lists, self.s
        whole = self._bounded(0, lists.docs, self.terms, lists.start[self.terms], lists.start[self.terms + 1])
        # Equal bounds: earlier documents first, as blocks are in order of ids.
        open_ = [(-whole[0], whole[1], whole)] if whole else []
        places = [(score, -doc) for score, doc in best]  # the worst place on top
        heapq.heapify(places)

        def offer(score: int, doc: int) -> None:
            if score <= 0:
                return
            if len(places) < s.best:
                heapq.heappush(places, (score, -doc))
            elif (score, -doc) > places[0]:
                heapq.heapreplace(places, (score, -doc))

        while open_:
            bound, lo, interval = heapq.heappop(open_)
            if len(places) == s.best and (-bound, -int(self.ids[lo])) <= places[0]:
                if -bound < places[0][0]:
                    break
                continue
            _, lo, hi, terms, a, b, doc = interval
            if hi - lo <= s.leaf:
                held, score = self._scores(interval)
                if len(places) == s.best:
                    near = score >= places[0][0]
                    held, score = held[near], score[near]
                for d, x in zip(self.ids[held].tolist(), score.tolist()):
                    offer(x, d)
                continue
            # Where the split document stands in each list, or would stand.
            at = np.searchsorted(lists.key, terms * (lists.docs + 1) + doc)
            own = (at < b) & (lists.doc[np.minimum(at, len(lists.doc) - 1)] == doc)
            offer(int(lists.impact[at[own]].sum()), int(self.ids[doc]))
            self.scored += 1
            for part in (self._bounded(lo, doc, terms, a, at), self._bounded(doc + 1, hi, terms, at + own, b)):
                if part and (len(places) < s.best or part[0] >= places[0][0]):
                    heapq.heappush(open_, (-part[0], part[1], part))
        return sorted(((score, -doc) for score, doc in places), key=lambda x: (-x[0], x[1]))


def _search(shared, s: Settings):
    """Places of every query over the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, docs_all, terms_all = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in items]

        def block(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            id_ = table["doc_id"]
            ids = id_.fill_null(_LAST).to_numpy()
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            terms = table["terms"].combine_chunks()
            often = table["often"].combine_chunks()
            count = np.asarray(terms.value_lengths()).astype(np.int64)
            doc, n = np.repeat(place, count), np.repeat(table["n"].to_numpy(), count)
            term, tf = terms.flatten().to_numpy(), often.flatten().to_numpy()
            m = 50 + (50 * n * docs_all) // terms_all
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            lists = Lists(term, doc, impact, len(ids), len(weight))
            for q, own in enumerate(items):
                best[q] = Search(lists, ids[order], own, s).run(best[q])

        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            terms = batch.column(batch.schema.get_field_index("terms"))
            step = max(1, int(batch.num_rows * s.postings / max(1, len(terms.flatten()))))
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                held.append(part)
                size += len(part.column(part.schema.get_field_index("terms")).flatten())
                if size >= s.postings:
                    block(held)
                    held, size = [], 0
        if held:
            block(held)
        found = [(q, d, x) for q, own in enumerate(best) for x, d in own]
        if found:
            q, d, x = zip(*found)
            named = pa.array(d, pa.int64(), mask=np.array(d) == _LAST)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), named, pa.array(x, pa.int64())], names=["query", "doc_id", "score"])

    return run


def _places(found: DataFrame, keys: list[str], best: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _turn(docs: DataFrame, asked: DataFrame, s: Settings) -> DataFrame:
    """Places of the queries whose (item, term) rows are given, about ``s.terms``."""
    spark = docs.sparkSession
    rows = asked.orderBy("item", "term").toArrow()  # bounded by ``terms``
    item, first = np.unique(rows["item"].to_numpy(), return_index=True)
    sought, term = np.unique(rows["term"].to_numpy().view(_U), return_inverse=True)
    items = np.split(term.astype(np.int64), first[1:])

    table = store.written(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            _postings(spark.sparkContext.broadcast(sought)), "doc_id long, n long, terms array<int>, often array<long>"
        ),
        "postings",
    )
    whole = table.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    if not whole["terms"]:
        return None
    df = np.zeros(len(sought), np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[r["term"]] = r["count"]
    n = whole["docs"]
    # One value at a time: the logarithm of the C library, not a vector one.
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((items, weight, n, whole["terms"]))
    found = table.where(F.size("terms") > 0).mapInArrow(_search(shared, s), "query int, doc_id long, score long")
    # A task gives ``best`` rows a query: merged in groups first, so that no task
    # gathers what all tasks found for one query.
    salted = found.withColumn("turn", F.pmod(F.xxhash64("doc_id", "score"), F.lit(s.turns)))
    merged = _places(_places(salted, ["query", "turn"], s.best).drop("rank"), ["query"], s.best)
    names = spark.createDataFrame(pa.table({"query": pa.array(np.arange(len(item)), pa.int32()), "item": pa.array(item)}))
    return merged.join(F.broadcast(names), "query").select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents (doc_id, text) of each of the
    queries ``items`` (item_id, text)."""
    s, spark = settings, docs.sparkSession
    key = dict(items.dtypes)["item_id"]
    # Inside a query is named by a fingerprint of its id, which comes back at the end.
    named = items.select("item_id", F.col("text").cast("string"), F.xxhash64("item_id").alias("item"))
    asked = store.written(named.mapInArrow(_item_terms, "item long, term long").distinct(), "asked")
    turns = max(1, math.ceil(asked.count() / s.terms))
    ids = named.groupBy("item").agg(F.first("item_id").alias("item_id"))
    parts = []
    for k in range(turns):
        own = asked.where(F.pmod(F.xxhash64("item", F.lit(3)), F.lit(turns)) == k)
        part = None if own.isEmpty() else _turn(docs, own, s)
        if part is not None:
            parts.append(part)
    if not parts:
        return spark.createDataFrame([], f"item_id {key}, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.join(ids, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
