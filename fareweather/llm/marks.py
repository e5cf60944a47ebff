"""What both removals of repeated passages share: rows by key, marks by document.

A mark is a stretch of a text packed into a long: start, length and two flags. The
flags tell that the stretch is repeated as a whole (``WHOLE``), or that some of its
windows may be and have to be looked at one by one (``SOME``). In rows by key, before
that is known, the flags' place holds the kind of the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fareweather.llm.anchors import Scheme, filed, union
from fareweather.llm.text import pieces, ranges

WHOLE, SOME = 2, 1
_LENGTH = 1 << 20
ROWS = "key long, context long, uid long, mark long"
ROWS_WITH_DOC = ROWS + ", doc long"
#: Kinds of rows: as filed; also repeated beside it in its batch; a finished stretch.
FILED, PAIRED, READY = 0, 1, 2


def packed(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (start << 24) | ((end - start) << 2)


def unpacked(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = mark >> 24
    return start, start + ((mark >> 2) & 0x3FFFFF)


def unique_ids(docs: DataFrame) -> bool:
    """Whether every row has an id of its own."""
    counts = docs.groupBy("doc_id").count().agg(F.max("count"), F.max(F.col("doc_id").isNull().cast("int"))).first()
    return counts[0] is None or (counts[0] == 1 and counts[1] == 0)


def free_name(docs: DataFrame, name: str) -> str:
    """A column name like the one given that the table does not have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def with_uid(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``uid``, the same for equal rows only, and never null.

    The id itself where ids are unique, else a fingerprint of the row."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.withColumn("uid", F.coalesce("doc_id", F.lit(0)) if unique_ids(docs) else F.xxhash64("doc_id", "text"))


def _runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks that cover the stretches; long ones in several parts."""
    starts, ends = union(starts, ends)
    parts = -(-(ends - starts) // _LENGTH)
    begin = ranges(np.zeros(len(parts), np.int64), parts) * _LENGTH + np.repeat(starts, parts)
    return packed(begin, np.minimum(begin + _LENGTH, np.repeat(ends, parts)))


def file_rows(scheme: Scheme, sequence, other_documents: bool):
    """Rows of each batch for all its windows. ``sequence`` makes prefix sums and
    offsets of a chunk. What is repeated within the batch is settled here, so a
    passage that many rows share leaves each batch as one row. With
    ``other_documents`` only repeats of a smaller document count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part, chunk in pieces(batch):
                prefix, offsets = sequence(chunk)
                r = filed(prefix, offsets, scheme)
                uid = part.column("uid").to_numpy()[r.text]
                doc = part.column("doc").to_numpy()[r.text] if other_documents else uid
                shift = offsets[r.text]
                start, end = r.at - r.high - shift, r.at - r.low + scheme.length - shift
                found.append((r.key.view(np.int64), r.context.view(np.int64), uid, doc, start, end))
            if not found:
                continue
            key, context, uid, doc, start, end = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((start, doc, context, key))
            key, context, uid, doc, start, end = (c[order] for c in (key, context, uid, doc, start, end))
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (context[1:] != context[:-1])])
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            ready = doc > doc[first] if other_documents else ~new
            kind = np.full(len(key), FILED)
            if not other_documents:
                kind[new] = np.where(np.append(new[1:], True)[new], FILED, PAIRED)
            keep = ~ready
            columns = [key[keep], context[keep], uid[keep], (packed(start, end) | kind)[keep], doc[keep]]
            if ready.any():
                by = np.lexsort((start[ready], uid[ready]))
                u, s, e = uid[ready][by], start[ready][by], end[ready][by]
                edge = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1], [True]]))
                runs = [_runs(s[a:b], e[a:b]) for a, b in zip(edge, edge[1:])]
                owner = np.repeat(u[edge[:-1]], [len(x) for x in runs])
                mark = np.concatenate(runs)
                spread = (owner * np.int64(0x1E3779B97F4A7C15) + mark) ^ (mark << 17)
                zero = np.zeros(len(mark), np.int64)
                more = [spread, zero, owner, mark | READY, zero]
                columns = [np.concatenate(x) for x in zip(columns, more)]
            names = ["key", "context", "uid", "mark", *["doc"] * other_documents]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns[: len(names)]], names=names)

    return run


def kind() -> Column:
    return F.col("mark").bitwiseAND(F.lit(3).cast("long"))


def by_key(rows: DataFrame, doc: str) -> DataFrame:
    """Rows with what their key's other rows tell: ``before`` and ``after`` (contexts
    next to it, in the order of contexts and documents), ``mixed`` (several contexts)."""
    order = W.partitionBy("key").orderBy("context", doc, "mark")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        rows.withColumn("before", F.lag("context").over(order))
        .withColumn("after", F.lead("context").over(order))
        .withColumn("mixed", F.first("context").over(whole) != F.last("context").over(whole))
    )


def flagged(whole: Column, some: Column) -> Column:
    flags = F.when(whole, WHOLE).otherwise(0) + F.when(some, SOME).otherwise(0)
    return F.col("mark").bitwiseAND(F.lit(-4).cast("long")).bitwiseOR(flags.cast("long"))


def removed(marks: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches covered by whole marks and by single windows."""
    whole = marks[marks & WHOLE > 0]
    start, end = unpacked(whole)
    return union(np.concatenate([start, windows]), np.concatenate([end, windows + length]))


def lists(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    """Arrays of a list column, empty for null."""
    column = batch.column(name)
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k, ok in enumerate(valid.tolist()):
        yield values[offsets[k] : offsets[k + 1]] if ok else np.empty(0, np.int64)
