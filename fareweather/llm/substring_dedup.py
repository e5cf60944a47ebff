"""Passages of words that an earlier document has already, and their removal.

Windows of ``length`` words are filed by content-defined anchors, so that all places
of a passage meet in one reference shard, whatever surrounds it. Stretches that agree
with an earlier document's as a whole are settled there. For the others a shard keeps
suffix automata of its references: stretches come in the order of their documents,
each is streamed against the automata of those before it, the matching statistics
tell which windows are there, and then it joins the reference.

The shards are spread by shuffling rather than broadcast, as the references (all
documents) have no size bound; an automaton that reaches ``states`` is closed and
the next begun. A key of very many rows has no shard: its windows are spread by
fingerprint, and only the least document of each is kept.

Words are parted by ASCII white space. A null text has none. Documents with fewer
words keep all. A null doc_id counts as larger than any other. Rows with equal ids
never remove each other's words, so repeated rows stay. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fareweather.llm import marks as M
from fareweather.llm import store
from fareweather.llm.anchors import Scheme, prefix_of
from fareweather.llm.text import Chunk, Words, list_column, mix, pieces, ranges

WORDS = Scheme(length=50, span=2, rates=(14, 4), cuts=(16, 32))

SCHEMA = "doc_id long, n_words long, n_removed long, starts array<long>, ends array<long>, kept binary"
_LAST = (1 << 63) - 1


class Automaton:
    """Suffix automaton of several sequences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def _clone(self, p: int, c: int, q: int) -> int:
        """A copy of state q for the shorter strings that reach it from p."""
        nxt, link, size = self.next, self.link, self.size
        new = len(nxt)
        nxt.append(nxt[q].copy())
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def add(self, sequence: list[int]) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._clone(last, c, q)
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if size[q] == size[p] + 1 else self._clone(p, c, q)
            last = new

    def matches(self, sequence: list[int]) -> Iterator[int]:
        """For each position the longest string ending there that the sequences hold."""
        nxt, link, size = self.next, self.link, self.size
        state = length = 0
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                length = size[state]
            to = nxt[state].get(c)
            if to is not None:
                state, length = to, length + 1
            yield length


def _sequence(chunk: Chunk):
    words = Words(chunk)
    return prefix_of(words.hash), words.of_text


def _windows(words: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of the ``length`` words from each place on."""
    found = []
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        sums = np.zeros(len(begin), np.uint64)
        for k in range(length):
            sums = sums * np.uint64(factor) + words[begin + k]
        found.append(mix(sums).view(np.int64))
    return found[0], found[1]


def _stretches(length: int):
    """The words of the stretches marked SOME. Those of a hot key go as single windows
    by fingerprint, and a window that rows of a batch share leaves it once: ``words``
    then hold the second fingerprint, or nothing where a smaller document is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc", "uid", "start", "words"]
        for batch in batches:
            hot = []
            for part, chunk in pieces(batch):
                words = Words(chunk)
                marks, keys, hots = (list(M.lists(part, c)) for c in ("marks", "keys", "hots"))
                owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
                start, end = M.unpacked(np.concatenate(marks))
                key, is_hot = np.concatenate(keys), np.concatenate(hots) > 0
                doc, uid = part.column("doc").to_numpy()[owner], part.column("uid").to_numpy()[owner]
                own = ranges((start + words.of_text[owner])[~is_hot], (end - start)[~is_hot])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[~is_hot]) for x in (key, doc, uid, start)] + [list_column(pa.array(words.hash[own].view(np.int64)), (end - start)[~is_hot])],
                    names=names,
                )
                if is_hot.any():
                    count = np.maximum(end - start - length + 1, 0)[is_hot]
                    at = ranges(start[is_hot], count)
                    one, two = _windows(words.hash, at + np.repeat(words.of_text[owner[is_hot]], count), length)
                    hot.append((one, two, np.repeat(doc[is_hot], count), np.repeat(uid[is_hot], count), at))
            if hot and sum(len(h[0]) for h in hot):
                one, two, doc, uid, at = (np.concatenate(c) for c in zip(*hot))
                order = np.lexsort((at, uid, doc, two, one))
                one, two, doc, uid, at = (c[order] for c in (one, two, doc, uid, at))
                new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
                least = doc[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
                # Only the least document's windows have to meet those of other batches.
                ready = doc > least
                spread = np.where(ready, uid * np.int64(0x1E3779B97F4A7C15) + at, one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (spread, doc, uid, at)] + [list_column(pa.array(two[~ready]), (~ready).astype(np.int64))], names=names
                )

    return run


def _stream(length: int, states: int):
    """Over stretches sorted by key and document: windows of smaller documents. Of
    single windows only the least document of a fingerprint is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = doc = None
        shards: list[Automaton] = []
        waiting: list[list[int]] = []
        least: dict[int, int] = {}
        for batch in batches:
            uids, ats = [], []
            columns = [batch.column(c).to_pylist() for c in ("key", "doc", "uid", "start", "words")]
            for k, d, uid, start, words in zip(*columns):
                if k != key:
                    key, doc, shards, waiting, least = k, d, [], [], {}
                if len(words) < 2:
                    if not words or d > least.setdefault(words[0], d):
                        uids.append(uid)
                        ats.append(start)
                    continue
                if d != doc:
                    # Stretches of one document never remove each other.
                    for w in waiting:
                        if not shards or len(shards[-1].next) > states:
                            shards.append(Automaton())
                        shards[-1].add(w)
                    doc, waiting = d, []
                hit: set[int] = set()
                for shard in shards:
                    hit.update(i for i, n in enumerate(shard.matches(words)) if n >= length)
                uids += [uid] * len(hit)
                ats += [start + i + 1 - length for i in sorted(hit)]
                waiting.append(words)
            if ats:
                yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(ats, pa.int64())], names=["uid", "at"])

    return run


def _cut(length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in pieces(batch):
                words = Words(chunk)
                data, rows = chunk.data.tobytes(), []
                begin, stop = words.start.tolist(), words.end.tolist()
                for k, (marks, windows) in enumerate(zip(M.lists(part, "marks"), M.lists(part, "windows"))):
                    a, b = int(words.of_text[k]), int(words.of_text[k + 1])
                    start, end = M.removed(marks, windows, length)
                    edges = [0, *np.stack([start, end], 1).ravel().tolist(), b - a]
                    kept = b" ".join(
                        data[begin[i] : stop[i]] for x, y in zip(edges[::2], edges[1::2]) for i in range(a + x, a + y)
                    )
                    rows.append((b - a, int((end - start).sum()), start, end, kept if keep_text else hashlib.sha256(kept).hexdigest().encode()))
                n = np.array([len(r[2]) for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                        list_column(pa.array(np.concatenate([r[2] for r in rows]), pa.int64()), n),
                        list_column(pa.array(np.concatenate([r[3] for r in rows]), pa.int64()), n),
                        pa.array([r[4] for r in rows], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "starts", "ends", "kept"],
                )

    return run


def deduplicate(docs: DataFrame, scheme: Scheme = WORDS, states: int = 500_000, digest: bool = False, hot: int = 1000) -> DataFrame:
    """Remove each word covered by a window of ``scheme.length`` words that also starts
    in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, starts and ends of the removed stretches (in
    words), and kept: the remaining words joined by spaces, or with ``digest`` their
    SHA-256 in hex. Keys of over ``hot`` rows are settled window by window, not by an
    automaton: neither memory nor time of a task grows with the square of such a group.
    """
    docs = M.with_uid(docs)
    given = docs.select("uid", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "text")
    rows = given.mapInArrow(M.file_rows(scheme, _sequence, True), M.ROWS_WITH_DOC)
    known = M.by_key(rows, "doc")
    run = W.partitionBy("key", "context").orderBy("doc", "mark")
    known = known.withColumn("least", F.first("doc").over(run))
    ready = M.kind() == M.READY
    whole = ready | (F.col("doc") > F.col("least"))
    some = F.col("mixed") & ~whole
    group = W.partitionBy("key").orderBy("context", "doc", "mark").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    known = known.withColumn("hot", (F.count("*").over(group) > hot).cast("long"))
    marks = store.written(
        known.where(whole | some).select("uid", "doc", "key", "hot", whole.alias("whole"), M.flagged(whole, some).alias("mark")), "marks"
    )

    unclear = marks.where("not whole").groupBy("uid", "doc").agg(
        F.collect_list(F.struct("mark", "key", "hot")).alias("both")
    ).select("uid", "doc", F.col("both.mark").alias("marks"), F.col("both.key").alias("keys"), F.col("both.hot").alias("hots"))
    parts = docs.select("uid", "text").join(unclear.hint("shuffle_hash"), "uid").select("uid", "doc", "text", "marks", "keys", "hots")
    parts = parts.mapInArrow(_stretches(scheme.length), "key long, doc long, uid long, start long, words array<long>")
    found = (
        parts.repartition("key").sortWithinPartitions("key", "doc", "uid", "start")
        .mapInArrow(_stream(scheme.length, states), "uid long, at long")
    )
    windows = found.groupBy("uid").agg(F.collect_set("at").alias("windows"))
    lists = marks.where("whole").groupBy("uid").agg(F.collect_list("mark").alias("marks")).join(windows, "uid", "full")
    whole_rows = docs.join(lists.hint("shuffle_hash"), "uid", "left").select("doc_id", "text", "marks", "windows")
    return whole_rows.mapInArrow(_cut(scheme.length, not digest), SCHEMA)
