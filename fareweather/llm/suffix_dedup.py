"""Repeated byte strings, found by prefix-free parsing, and their removal.

The parse: texts are cut into phrases where a rolling fingerprint of eight bytes
hits. Only suffixes that begin at phrase starts are ordered, each with the bytes
around it that a repeated string is sure to share, so equal strings meet wherever
they stand. Rows are put in corpus order by fingerprints of the shared part and of
all the rest (equality of ``length`` bytes is all that is asked for, and the
fingerprints of equal strings are equal); neighbours that agree in both are repeated
in full, and where only the shared part agrees, the single strings are compared.

A null text is empty. Texts shorter than ``length`` keep all their bytes. Rows that
are repeated repeat each other's bytes. Rows may share an id; each gives a row of
its own. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fareweather.llm import marks as M
from fareweather.llm import store
from fareweather.llm.anchors import Scheme
from fareweather.llm.text import Chunk, chunk_of, list_column, pieces, ranges, stretch

BYTES = Scheme(length=200, span=8, rates=(64, 12), cuts=(64, 128))

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept binary"


def _sequence(chunk: Chunk):
    return chunk.prefix(), chunk.offsets


def _single(scheme: Scheme):
    """Fingerprints of the strings in stretches marked SOME."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in pieces(batch):
                prefix, out = chunk.prefix(), []
                for k, marks in enumerate(M.lists(part, "marks")):
                    start, end = M.unpacked(marks[marks & M.SOME > 0])
                    out.append(np.unique(ranges(start, end - start - scheme.length + 1)))
                count = np.array([len(x) for x in out])
                at = np.concatenate(out) if out else np.empty(0, np.int64)
                owner = np.repeat(np.arange(len(count)), count)
                place = at + chunk.offsets[owner]
                whole = stretch(prefix, place, place + scheme.length)
                uid = part.column("uid").to_numpy()[owner]
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(uid), pa.array(at)], names=["print", "uid", "at"])

    return run


def _cut(scheme: Scheme, keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = chunk_of(batch.column("text"))
            data, offsets = chunk.data.tobytes(), chunk.offsets.tolist()
            rows = []
            for k, (marks, windows) in enumerate(zip(M.lists(batch, "marks"), M.lists(batch, "windows"))):
                text = data[offsets[k] : offsets[k + 1]]
                start, end = M.removed(marks, windows, scheme.length)
                if len(start):
                    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(text)]
                    text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                size = offsets[k + 1] - offsets[k]
                rows.append((size, size - len(text), start, end, text if keep_bytes else hashlib.sha256(text).hexdigest().encode()))
            n = np.array([len(r[2]) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(n, pa.int64()),
                    list_column(pa.array(np.concatenate([r[2] for r in rows]), pa.int64()), n),
                    list_column(pa.array(np.concatenate([r[3] for r in rows]), pa.int64()), n),
                    pa.array([r[4] for r in rows], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "starts", "ends", "kept"],
            )

    return run


def deduplicate(docs: DataFrame, scheme: Scheme = BYTES, digest: bool = False) -> DataFrame:
    """Remove each byte covered by a string of ``scheme.length`` bytes that also starts
    elsewhere, in the same text or another.

    Returns doc_id, n_bytes, n_removed, n_spans, starts and ends of the removed spans,
    and kept: the bytes that remain, or with ``digest`` their SHA-256 in hex.
    """
    docs = M.with_uid(docs)
    rows = docs.select("uid", "text").mapInArrow(M.file_rows(scheme, _sequence, False), M.ROWS)
    known = M.by_key(rows, "uid")
    same = F.coalesce(F.col("before") == F.col("context"), F.lit(False))
    whole = (M.kind() > M.FILED) | same | F.coalesce(F.col("after") == F.col("context"), F.lit(False))
    some = F.col("mixed") & ~same & (M.kind() < M.READY)
    marks = (
        known.where(whole | some).select("uid", M.flagged(whole, some).alias("mark"))
        .groupBy("uid").agg(F.collect_list("mark").alias("marks"))
    )
    marks = store.written(marks, "marks")

    unclear = marks.where(F.exists("marks", lambda x: x.bitwiseAND(F.lit(M.SOME)) > 0))
    # All columns of docs, as in the last join: Spark shuffles the texts once for both.
    single = docs.join(unclear.hint("shuffle_hash"), "uid").select("doc_id", "text", "uid", "marks")
    single = single.mapInArrow(_single(scheme), "print long, uid long, at long")
    again = single.withColumn("n", F.count("*").over(W.partitionBy("print"))).where("n > 1")
    windows = again.groupBy("uid").agg(F.collect_list("at").alias("windows"))
    both = marks.join(windows, "uid", "left")
    whole_rows = docs.join(both.hint("shuffle_hash"), "uid", "left").select("doc_id", "text", "marks", "windows")
    return whole_rows.mapInArrow(_cut(scheme, not digest), SCHEMA)
