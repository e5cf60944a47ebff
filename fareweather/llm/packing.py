"""Pack token sequences into windows with a fixed number of open windows.

Each task walks its documents once. A document is cut into whole windows and a
rest; the rest goes into the open window it fills best. When it fits in none, the
fullest window is closed: filled up with the head of the rest if more than
``slack`` tokens of it would be padding, else as it is. Memory is the open windows. What is open at
the end of a task is merged in rounds, ``fan_in`` tasks at a time, until one group
is left; there the contents are laid end to end, so one window at most is short.

Nulls: a null text counts as empty and yields the end token alone. Rows without an
id, repeated ids and extra columns do not matter: each row is a document of its
own. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fareweather.llm import store
from fareweather.llm.text import Chunk, Words, pieces, ranges, stretch

SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
    "offset long, ids binary, task long, open boolean"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("ids", pa.binary()), ("task", pa.int64()), ("open", pa.bool_()),
    ]
)

#: Runs of these letters alone are one unit of the tokenizer, lower-cased one by one.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _units(chunk: Chunk) -> Words:
    """Words, cut where an ASCII letter meets another ASCII character.

    The tokenizers meant here start a new unit there as well. Words that hold an
    apostrophe (contractions) or "<|" (special tokens) stay whole.
    """
    data, words = chunk.data, Words(chunk)
    kind = _KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    # A Latin letter of two bytes (C3 xx, but for the signs 97 and B7) before an ASCII sign.
    cut[2:] |= (kind[2:] == 2) & (data[:-2] == 0xC3) & (data[1:-1] >= 0x80) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
    odd = data == 0x27
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    if odd.any():
        whole = np.unique(np.searchsorted(words.start, np.flatnonzero(odd), "right") - 1)
        whole = whole[whole >= 0]
        cut[ranges(words.start[whole], words.end[whole] - words.start[whole])] = False
    cut[words.start] = False
    at = np.flatnonzero(cut)
    inner = at[kind[at] != 3]
    start = np.sort(np.concatenate([words.start, inner]))
    end = np.sort(np.concatenate([words.end, inner]))
    words.start, words.end = start, end
    words.of_text = np.searchsorted(start, chunk.offsets)
    words.hash = stretch(chunk.prefix(True), start, end)
    return words


#: Of each byte: 0 outside ASCII, 1 a letter, 2 another sign, 3 white space.
_KIND = np.zeros(256, np.uint8)
_KIND[:128] = 2
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 3


class WordTokens:
    """Token ids by word, for lower-casing BPE that never joins across white space.

    Units are encoded once and remembered by fingerprint, up to ``limit`` units.
    """

    def __init__(self, path: str, limit: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tool, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tool.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if c != 0xF7]
        self.letters = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self.clear()

    def clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _ids(self, text: str) -> list[int]:
        if _LATIN.fullmatch(text):
            return [t.id for t in self.model.tokenize(text.lower().translate(self.letters))]
        return self.tool.encode(text, add_special_tokens=False).ids

    def __call__(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunk's texts in a row, and how many each text has."""
        words = _units(chunk)
        keys, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.known) > self.limit:
            self.clear()
        place = np.searchsorted(self.known, keys)
        fresh = np.ones(len(keys), bool)
        if len(self.known):
            fresh = self.known[np.minimum(place, len(self.known) - 1)] != keys
        if fresh.any():
            data, i = chunk.data.tobytes(), first[fresh]
            lists = [
                self._ids(data[a:b].decode("utf-8", "replace"))
                for a, b in zip(words.start[i].tolist(), words.end[i].tolist())
            ]
            count = np.array([len(x) for x in lists])
            ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum()))
            self.at = np.insert(self.at, place[fresh], len(self.flat) + np.cumsum(count) - count)
            self.count = np.insert(self.count, place[fresh], count)
            self.known = np.insert(self.known, place[fresh], keys[fresh])
            self.flat = np.concatenate([self.flat, ids])
            place = np.searchsorted(self.known, keys)
        at, count = self.at[place][back], self.count[place][back]
        sums = np.concatenate([[0], np.cumsum(count)])
        return self.flat[ranges(at, count)], np.diff(sums[words.of_text])


@dataclass
class Piece:
    doc: int | None
    start: int
    total: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.total, self.ids[:n]),
            Piece(self.doc, self.start + n, self.total, self.ids[n:]),
        )


class Packer:
    """A fixed number of open windows, kept in order of their free room."""

    def __init__(self, size: int, windows: int, slack: int):
        self.size, self.windows, self.slack = size, windows, slack
        self.room: list[int] = []
        self.open: list[list[Piece]] = []

    def _put(self, room: int, window: list[Piece]) -> None:
        i = bisect.bisect_left(self.room, room)
        self.room.insert(i, room)
        self.open.insert(i, window)

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece; gives the windows that are closed by it."""
        while len(piece.ids) >= self.size:
            head, piece = piece.cut(self.size)
            yield [head]
        n = len(piece.ids)
        if not n:
            return
        i = bisect.bisect_left(self.room, n)
        if i < len(self.room):
            room, window = self.room.pop(i), self.open.pop(i)
            window.append(piece)
            if room == n:
                yield window
            else:
                self._put(room - n, window)
            return
        if len(self.room) >= self.windows:
            room, window = self.room.pop(0), self.open.pop(0)
            if room > self.slack:
                head, piece = piece.cut(room)
                window.append(head)
                yield window
                yield from self.add(piece)
                return
            yield window
        self._put(self.size - n, [piece])

    def end_to_end(self) -> Iterator[list[Piece]]:
        """Close all: contents in a row, cut where a window is full."""
        window, room = [], self.size
        for piece in (p for w in self.open for p in w):
            while len(piece.ids) >= room:
                head, piece = piece.cut(room)
                yield [*window, head]
                window, room = [], self.size
            if len(piece.ids):
                window.append(piece)
                room -= len(piece.ids)
        if window:
            yield window


class _Rows:
    """Collect the pieces of windows into Arrow batches."""

    def __init__(self, task: int, high: int, rows: int = 2000):
        self.task, self.next, self.rows, self.out = task, high + (task << 32), rows, []

    def add(self, window: list[Piece], still_open: bool = False) -> None:
        at = 0
        for p in window:
            self.out.append((p.doc, p.start, len(p.ids), p.total, self.next, at, p.ids.tobytes(), self.task, still_open))
            at += len(p.ids)
        self.next += 1

    def take(self, all_rows: bool = False) -> Iterator[pa.RecordBatch]:
        if self.out and (all_rows or len(self.out) >= self.rows):
            columns = zip(*self.out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
            self.out = []


def _first_round(path: str, end_id: int, size: int, windows: int, slack: int):
    def run(batches):
        tokens = WordTokens(path)
        packer, rows = Packer(size, windows, slack), _Rows(TaskContext.get().partitionId(), 0)
        for batch in batches:
            for part, chunk in pieces(batch, limit=4 << 20):
                ids, count = tokens(chunk)
                at = 0
                for doc, n in zip(part.column(0).to_pylist(), count.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for window in packer.add(Piece(doc, 0, n + 1, own)):
                        rows.add(window)
                    yield from rows.take()
        for window in packer.open:
            rows.add(window, True)
        yield from rows.take(True)

    return run


def _later_round(level: int, size: int, windows: int, slack: int, last: bool):
    def run(batches):
        packer, rows, group = Packer(size, windows, slack), None, None

        def close():
            for window in packer.end_to_end() if last else packer.open:
                rows.add(window, not last)

        for batch in batches:
            for r in batch.to_pylist():
                if r["task"] != group:
                    if rows is not None:
                        close()
                        yield from rows.take(True)
                    group = r["task"]
                    packer, rows = Packer(size, windows, slack), _Rows(group, level << 58)
                for window in packer.add(Piece(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4"))):
                    rows.add(window)
                yield from rows.take()
        if rows is not None:
            close()
            yield from rows.take(True)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 1,
    size: int = 2048,
    windows: int = 64,
    slack: int = 16,
    fan_in: int = 64,
) -> DataFrame:
    """Pieces of all documents with their place in sequences of ``size`` tokens.

    Returns doc_id, start, length, doc_tokens, sequence_id, offset and ids (the
    piece's tokens as little-endian unsigned 32-bit integers).
    """
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    done = store.written(given.mapInArrow(_first_round(tokenizer, end_id, size, windows, slack), SCHEMA), "pack")
    tasks = done.where("open").agg(F.max("task")).first()[0]
    out, rest, level = [done.where("not open")], done.where("open"), 1
    while tasks is not None:
        tasks //= fan_in
        rest = (
            rest.withColumn("task", F.floor(F.col("task") / fan_in).cast("long"))
            .repartition(int(min(tasks + 1, 10_000)), "task")
            .sortWithinPartitions("task", "sequence_id", "offset")
        )
        rest = store.written(rest.mapInArrow(_later_round(level, size, windows, slack, tasks == 0), SCHEMA), "pack")
        out.append(rest.where("not open"))
        rest, level = rest.where("open"), level + 1
        if tasks == 0:
            break
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.drop("task", "open")
