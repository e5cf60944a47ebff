"""Log-probabilities of texts by logistic mixing of hashed-context bit predictors.

Tokens become bits on the paths of a Huffman tree over the most frequent tokens and
one leaf for all others. For each bit several predictors answer: the node's own
share, hashed tables of counts under contexts of earlier tokens, and the document
so far. Their logits are combined with weights chosen by a gate (how much the tables
know), and the weights are refined while a document is read, block by block. What
the tree leaves open, which of the rarer tokens it is, is answered by the counts of
all training tokens; a token never seen has the share of one half.

Counts cover all training documents and are joined, so they may grow with the
corpus; what is broadcast (frequent tokens, tables of ``2**slot_bits`` counters) has
a fixed size. Start weights are learned from all training documents, in parts: each
part is read with the tables of the other parts, so no document meets its own counts.

A null text is empty: its only token is the end. With no training rows every token
is unknown. Rows may share an id; each gives a row of its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from fareweather.llm import store
from fareweather.llm.marks import unique_ids, with_uid
from fareweather.llm.text import CHUNK_BYTES, Words, list_column, mix, pieces, ranges

_U = np.uint64
#: Fingerprint of the end token; no word has it.
END = np.uint64(0x517CC1B727220A95)
_CONTEXTS = 3
_INPUTS = _CONTEXTS + 2
_GATES = 12
_PART = 1 << 15
#: Leading bits by which a frequent token is looked up.
_LEAD = 16
#: Tokens whose bits are found at a time.
_FEW = 1 << 13
#: Rarer tokens that are put together before they leave a task.
_RARE = 1 << 21


@dataclass(frozen=True)
class Settings:
    """``frequent``: leaves of the tree; ``slot_bits``: log2 of a table's slots;
    ``block``: tokens between two refinements; ``rate`` of refining; ``own``: weight
    of the corpus in the document's own shares; ``held_back``: parts of the training
    documents, each held back from the tables with which it teaches the start weights;
    ``rounds`` in which all of them are read."""

    frequent: int = 4096
    slot_bits: int = 19
    block: int = 48
    rate: float = 0.004
    own: float = 3.0
    held_back: int = 2
    rounds: int = 1


class Tree:
    """Huffman tree: for each symbol the nodes and bits on its path."""

    def __init__(self, weights: np.ndarray):
        n = len(weights)
        heap = [(float(w), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        up, side, node_total, node_one = {}, {}, {}, {}
        nodes = 0
        while len(heap) > 1:
            (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
            own = n + nodes
            up[a], up[b], side[a], side[b] = own, own, 0, 1
            node_total[nodes], node_one[nodes] = wa + wb, wb
            heapq.heappush(heap, (wa + wb, own))
            nodes += 1
        paths, bits, size = [], [], []
        for i in range(n):
            k, path, bit = i, [], []
            while k in up:
                bit.append(side[k])
                k = up[k]
                path.append(k - n)
            size.append(len(path))
            paths += path[::-1]
            bits += bit[::-1]
        self.node, self.bit = np.array(paths, np.int64), np.array(bits, np.int64)
        self.size = np.array(size, np.int64)
        self.start = np.cumsum(self.size) - self.size
        #: What the node of each place adds to the hash of a context.
        self.step = self.node.astype(_U) * _U(0xC2B2AE3D27D4EB4F)
        share = np.array([(node_one[i] + 0.25) / (node_total[i] + 0.5) for i in range(nodes)])
        self.share = share if nodes else np.full(1, 0.5)


@dataclass
class Model:
    """``known``: fingerprints of frequent tokens, ascending; ``counts`` of them."""

    known: np.ndarray
    counts: np.ndarray
    tree: Tree
    total: int
    distinct: int
    rare_total: float
    rare_distinct: int
    settings: Settings
    tables: np.ndarray | None = None
    weights: np.ndarray | None = None
    first: np.ndarray | None = None
    most: int = 0

    def symbols(self, tokens: np.ndarray) -> np.ndarray:
        """Index among the frequent tokens; their number for any other."""
        rare = len(self.known)
        if not rare:
            return np.zeros(len(tokens), np.int64)
        if self.first is None:
            # By the leading bits: the first known token with them, and the most that share them.
            edge = np.searchsorted(self.known, np.arange(1 << _LEAD, dtype=_U) << _U(64 - _LEAD))
            self.first, self.most = edge, int(np.diff(np.append(edge, rare)).max())
        at = self.first.take((tokens >> _U(64 - _LEAD)).view(np.int64))
        last = np.append(self.known, _U((1 << 64) - 1))
        for _ in range(self.most):
            at += last.take(at) < tokens
        return np.where((last.take(at) == tokens) & (at < rare), at, rare)


class Tokens:
    """Tokens of a chunk's texts: words, then an end each."""

    def __init__(self, chunk):
        words = Words(chunk, True)
        texts = len(chunk)
        self.hash = np.empty(len(words) + texts, _U)
        self.hash[np.arange(len(words)) + words.text_index()] = words.hash
        self.begin = words.of_text[:-1] + np.arange(texts)
        self.stop = words.of_text[1:] + np.arange(texts) + 1
        self.hash[self.stop - 1] = END
        self.count = self.stop - self.begin


class Events:
    """Bits of the tokens' paths with the slots of their contexts, token by token in
    the order given (as they stand, if none is): ``size`` of them each, ``path`` their
    places in the tree."""

    def __init__(self, tokens: Tokens, symbol: np.ndarray, model: Model, order: np.ndarray | None = None):
        tree, bits = model.tree, model.settings.slot_bits
        n, rare = len(symbol), len(model.known)
        first = np.zeros(n, bool)
        first[tokens.begin] = True
        one = np.concatenate([[rare + 1], symbol[:-1]])[:n]
        one[first] = rare + 1
        two = np.concatenate([[rare + 1], one[:-1]])[:n]
        two[first] = rare + 1
        # The last frequent token before, whatever stands between.
        place = np.where(first, np.arange(n), 0)
        seen = np.where((one < rare) & ~first, np.arange(n), place)
        last = np.maximum.accumulate(seen)
        skip = np.where(first[last], rare + 1, one[last])
        skip_two = np.where(one == rare, two, rare + 2)
        contexts = [mix(c.astype(_U) + _U((k + 1) << 40)) for k, c in enumerate((one, one * (rare + 3) + two, skip * (rare + 3) + skip_two))]
        if order is not None:
            symbol, contexts = symbol[order], [c[order] for c in contexts]
        self.tree, self.size = tree, tree.size[symbol]
        self.path = ranges(tree.start[symbol], self.size)
        self.slots = [np.empty(len(self.path), np.int64) for _ in contexts]
        edge = np.concatenate([[0], np.cumsum(self.size)])
        # A few tokens at a time, so that what is between stays in the cache.
        for at in range(0, n, _FEW):
            size, bounds = self.size[at : at + _FEW], slice(edge[at], edge[min(at + _FEW, n)])
            step = tree.step.take(self.path[bounds], mode="clip")
            for slots, context in zip(self.slots, contexts):
                h = np.repeat(context[at : at + _FEW], size)
                h ^= step
                h *= _U(0x9E3779B97F4A7C15)
                np.right_shift(h, _U(64 - bits), out=slots[bounds].view(_U))

    @property
    def bit(self) -> np.ndarray:
        return self.tree.bit.take(self.path)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Tokens(chunk).hash for _, chunk in pieces(batch, limit=CHUNK_BYTES // 4)]
        if found:
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "count"])


def _by_part(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each part of the training documents."""
    number = batch.column(batch.schema.get_field_index("part"))
    for k in range(parts):
        rows = batch.filter(pc.equal(number, k))
        if rows.num_rows:
            yield k, rows


def _train(shared):
    """Counts of zero and one bits in each slot, by part, at the end of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        slots = 1 << model.settings.slot_bits
        tables = np.zeros((model.settings.held_back, _CONTEXTS, slots * 2), np.uint32)
        seen = 0
        for batch in batches:
            for part, rows in _by_part(batch, model.settings.held_back):
                for _, chunk in pieces(rows):
                    tokens = Tokens(chunk)
                    events = Events(tokens, model.symbols(tokens.hash), model)
                    bit = events.bit
                    # No counter of a task may pass the largest number.
                    seen += len(bit)
                    if seen >= 1 << 32:
                        yield from _filled(tables)
                        tables[:], seen = 0, len(bit)
                    for k, slot in enumerate(events.slots):
                        np.add.at(tables[part, k], slot * 2 + bit, np.uint32(1))
        yield from _filled(tables)

    return run


def _filled(tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = tables.ravel()
    for k in range(0, len(flat), _PART):
        own = flat[k : k + _PART]
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array([k // _PART], pa.int32()), pa.array([own.astype("<u4").tobytes()], pa.binary())], names=["part", "counts"])


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, "<u4").astype(np.int64) for c in table["counts"].to_pylist())
    return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes()], pa.binary())})


class _Mixer:
    """Scores the texts of a chunk, refining each text's weights as it goes."""

    def __init__(self, model: Model, tables: np.ndarray):
        self.model = model
        counts = tables.reshape(_CONTEXTS, -1, 2)
        # All that is looked up at random stands in one stretch, which large pages may hold.
        slots = counts.shape[1]
        room = np.empty(slots * (4 * _CONTEXTS + 2), np.int8)
        self.logit = room[: slots * 4 * _CONTEXTS].view(np.float32).reshape(_CONTEXTS, slots)
        self.know = room[slots * 4 * _CONTEXTS :].reshape(2, slots)
        level = []
        for k in range(_CONTEXTS):
            one = counts[k, :, 1].astype(np.float64)
            total = counts[k, :, 0] + one
            share = (one + 0.4) / (total + 0.8)
            self.logit[k] = np.log(share / (1 - share))
            level.append(np.minimum(np.log2(total + 1), 12).astype(np.int8))
        # A gate is the sum of what the first and the second table know.
        self.know[0] = np.minimum(level[0] // 3, 2) * 4
        self.know[1] = np.minimum(level[1] // 2, 3)
        tree, share = model.tree, model.tree.share
        self.nodes = len(share)
        # By place on a path: the side taken, what the node says, the corpus' part in own shares.
        self.side = 2 * tree.node + tree.bit
        self.sign = (1 - 2 * tree.bit).astype(np.float32)
        self.base = np.log(share / (1 - share)).astype(np.float32)[tree.node]
        self.prior = (np.float32(model.settings.own) * share.astype(np.float32))[tree.node]

    def __call__(self, tokens: Tokens, symbol: np.ndarray, score: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of each text's paths, if asked for; the texts' last
        weights."""
        model, s = self.model, self.model.settings
        texts = len(tokens.count)
        out = np.zeros(texts)
        cells = texts * _GATES
        # By input: the weight of each text and gate.
        weights = np.tile(model.weights.astype(np.float32).T, texts)
        if not len(model.tree.node) or not texts:
            return out, self._by_text(weights, texts)
        # Tokens by block, texts side by side: the bits of a block stand together.
        text = np.repeat(np.arange(texts), tokens.count)
        block = (np.arange(len(text)) - tokens.begin[text]) // s.block
        order = np.argsort(block.astype(np.min_scalar_type(int(block.max()))), kind="stable")
        events = Events(tokens, symbol, model, order)
        stop = np.cumsum(events.size)[np.cumsum(np.bincount(block)) - 1].tolist()
        owner = text[order]
        # One table after another, for all bits of the chunk; no index lies outside, and
        # "clip" saves the test for that.
        x = np.empty((_INPUTS - 1, len(events.path)), np.float32)
        np.take(self.base, events.path, out=x[0], mode="clip")
        for k, slot in enumerate(events.slots):
            np.take(self.logit[k], slot, out=x[k + 1], mode="clip")
        key = np.repeat(owner * _GATES, events.size)
        for known, slot in zip(self.know, events.slots):
            key += known.take(slot, mode="clip")
        sign, prior = self.sign.take(events.path, mode="clip"), self.prior.take(events.path, mode="clip")
        # How often the text itself took either side of a node: two places a node.
        side = np.repeat(owner * (2 * self.nodes), events.size)
        side += self.side.take(events.path, mode="clip")
        del events
        own = np.zeros(2 * texts * self.nodes, np.float32)
        pairs = own.reshape(-1, 2)
        whole = np.float32(s.own)
        moves = np.empty((_INPUTS, cells))
        for begin, end in zip([0, *stop], stop):
            at = slice(begin, end)
            cell, flip = key[at], sign[at]
            so_far = pairs.take(side[at] >> 1, axis=0, mode="clip")
            ones = so_far[:, 1] + prior[at]
            ones /= so_far[:, 0] + (whole - prior[at])
            now = [*x[:, at], np.log(ones, out=ones)]
            z = weights[0].take(cell, mode="clip") * now[0]
            for k in range(1, _INPUTS):
                more = weights[k].take(cell, mode="clip")
                more *= now[k]
                z += more
            # The share of the side that was taken, and what it falls short of one.
            z *= flip
            other = np.exp(np.clip(z, -30, 30, out=z), out=z)
            if score:
                out -= np.bincount(cell, np.log1p(other), cells).reshape(texts, _GATES).sum(axis=1)
            error = other / (1 + other)
            error *= flip
            for k in range(_INPUTS):
                moves[k] = np.bincount(cell, error * now[k], cells)
            weights -= s.rate * np.clip(moves, -50, 50, out=moves).astype(np.float32)
            np.add.at(own, side[at], np.float32(1))
        return out / np.log(10), self._by_text(weights, texts)

    @staticmethod
    def _by_text(weights: np.ndarray, texts: int) -> np.ndarray:
        return weights.reshape(_INPUTS, texts, _GATES).transpose(1, 2, 0)


def _parts(batch: pa.RecordBatch, rows: int = 64):
    """Chunks of a bounded number of texts, as each holds shares of its own; small, as
    all that a chunk needs should stay in the cache.

    Texts of like length stand together: the passes over a chunk are as many as its
    longest text needs.
    """
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0)
    batch = batch.take(pa.array(np.argsort(size.to_numpy(zero_copy_only=False), kind="stable")))
    for at in range(0, batch.num_rows, rows):
        yield from pieces(batch.slice(at, rows), limit=CHUNK_BYTES // 2)


def _score(shared):
    names = ["uid", "doc_id", "n_tokens", "n_top", "top_log", "n_rare", "path_log", "n_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        mixer = _Mixer(model, model.tables)
        log_counts = np.append(np.log10(model.counts + 0.5), 0.0)
        for batch in batches:
            for part, chunk in _parts(batch):
                tokens = Tokens(chunk)
                symbol = model.symbols(tokens.hash)
                text = np.repeat(np.arange(len(chunk)), tokens.count)
                rare = symbol == len(model.known)
                n_rare = np.bincount(text, rare, len(chunk)).astype(np.int64)
                paths, _ = mixer(tokens, symbol)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"), part.column("doc_id"), pa.array(tokens.count), pa.array(tokens.count - n_rare),
                        pa.array(np.bincount(text, log_counts[symbol], len(chunk))), pa.array(n_rare), pa.array(paths), pa.array(np.diff(chunk.offsets)),
                    ],
                    names=names,
                )

    return run


def _rare_tokens(shared):
    """Each rarer token with the rows it stands in, once for each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        values, uids, waiting = [], [], 0
        for batch in batches:
            for part, chunk in pieces(batch, limit=CHUNK_BYTES // 4):
                tokens = Tokens(chunk)
                rare = model.symbols(tokens.hash) == len(model.known)
                values.append(tokens.hash[rare])
                uids.append(np.repeat(part.column("uid").to_numpy(), tokens.count)[rare])
                waiting += len(values[-1])
                if waiting >= _RARE:
                    yield _gathered(values, uids)
                    values, uids, waiting = [], [], 0
        if waiting:
            yield _gathered(values, uids)

    return run


def _gathered(values: list[np.ndarray], uids: list[np.ndarray]) -> pa.RecordBatch:
    value, uid = np.concatenate(values), np.concatenate(uids)
    order = np.argsort(value)
    value, uid = value[order], uid[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    count = np.diff(np.append(first, len(value)))
    return pa.RecordBatch.from_arrays([pa.array(value[first].view(np.int64)), list_column(pa.array(uid), count)], names=["token", "uids"])


def fit(docs: DataFrame, training: Column, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model, and the counts of all training tokens."""
    s, spark = settings, docs.sparkSession
    taught = docs.where(training)
    counts = store.written(
        taught.select("text").mapInArrow(_word_counts, "token long, count long").groupBy("token").agg(F.sum("count").alias("count")), "counts"
    )
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("count"), "token").limit(s.frequent).collect()
    keys = np.array([r["token"] for r in top], np.int64).view(_U)
    order = np.argsort(keys)
    known, own = keys[order], np.array([r["count"] for r in top], np.int64)[order]
    rare_total = float(total - own.sum())
    rare_distinct = distinct - len(known)
    tree = Tree(np.append(own.astype(float), rare_total + 0.5 * (rare_distinct + 1)))
    model = Model(known, own, tree, total, distinct, rare_total, rare_distinct, s)
    shared = spark.sparkContext.broadcast(model)
    part = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(s.held_back)).cast("int").alias("part")
    taught = taught.select(part, "text")
    own_tables = _tables(taught, shared)
    # Each part's counts end at the largest; so do their sums.
    all_tables = own_tables.sum(axis=0, dtype=np.int64)
    model.weights = np.full((_GATES, _INPUTS), 0.3)
    if total and s.rounds:
        model.tables = np.stack([_ending(all_tables - own) for own in own_tables])
    for _ in range(s.rounds if total else 0):
        ends, share = _ends(taught, spark.sparkContext.broadcast(model))
        model.weights = (ends / max(share, 1)).reshape(model.weights.shape)
    # Nothing is left out of the counts that score.
    model.tables = _ending(all_tables)
    return model, counts


def _ending(tables: np.ndarray) -> np.ndarray:
    return np.minimum(tables, (1 << 32) - 1).astype(np.uint32)


#: Weights are summed in whole parts of so many, so the order of rows is no matter.
_UNIT = float(1 << 20)


def _refined(shared):
    """Sums over texts: tokens, and each last weight times the tokens. A part's texts
    are read with the tables of the other parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        mixers: dict[int, _Mixer] = {}
        for batch in batches:
            for part, rows in _by_part(batch, model.settings.held_back):
                if part not in mixers:
                    mixers[part] = _Mixer(model, model.tables[part])
                for _, chunk in _parts(rows):
                    tokens = Tokens(chunk)
                    _, last = mixers[part](tokens, model.symbols(tokens.hash), score=False)
                    whole = np.rint(last.astype(np.float64) * _UNIT).astype(np.int64).reshape(len(chunk), -1)
                    sums = (whole * tokens.count[:, None]).sum(axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(len(sums) + 1), pa.int32()), pa.array(np.append(sums, tokens.count.sum()))], names=["cell", "total"]
                    )

    return run


def _ends(rows: DataFrame, shared) -> tuple[np.ndarray, int]:
    """Weights at the end of each text times its tokens, summed; all tokens."""
    sums = rows.mapInArrow(_refined(shared), "cell int, total long")
    found = sums.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()
    shared.unpersist()
    out = np.zeros(_GATES * _INPUTS + 1)
    for r in found:
        out[r["cell"]] = float(r["total"])
    return out[:-1] / _UNIT, int(out[-1])


def _tables(taught: DataFrame, shared) -> np.ndarray:
    """Counts under all contexts, summed over the rows of each part."""
    s = shared.value.settings
    parts = taught.mapInArrow(_train(shared), "part int, counts binary")
    for width in (16, 1):  # sums of a few parts at a time
        parts = parts.withColumn("turn", (F.rand(6) * width).cast("int")).groupBy("part", "turn").applyInArrow(_add, "part int, counts binary")
    tables = np.zeros(s.held_back * (1 << s.slot_bits) * 2 * _CONTEXTS, np.uint32)
    for r in parts.toLocalIterator():
        tables[r["part"] * _PART : (r["part"] + 1) * _PART] = np.frombuffer(r["counts"], "<u4")
    return tables.reshape(s.held_back, -1)


def score(docs: DataFrame, training: Column, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_tokens, n_known, train_tokens,
    base_score (by counts alone), score (of the model) and bits_per_byte.

    ``training`` is a condition on doc_id: the rows to learn from."""
    docs = with_uid(docs)
    unique = unique_ids(docs)
    model, counts = fit(docs, training, settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.select("uid", "doc_id", "text").mapInArrow(
        _score(shared), "uid long, doc_id long, n_tokens long, n_top long, top_log double, n_rare long, path_log double, n_bytes long"
    )
    given = docs if unique else docs.dropDuplicates(["uid"])
    rare = given.select("uid", "text").mapInArrow(_rare_tokens(shared), "token long, uids array<long>")
    number = F.coalesce("count", F.lit(0))
    seen = rare.join(counts, "token", "left").select(
        F.explode("uids").alias("uid"), F.log10(number + 0.5).alias("log"), (number > 0).cast("long").alias("is_known")
    )
    sums = seen.groupBy("uid").agg(F.sum("log").alias("rare_log"), F.sum("is_known").alias("rare_known"))
    out = scored.join(sums, "uid", "left")
    rare_log, rare_known = F.coalesce("rare_log", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    base = F.col("top_log") + rare_log - F.col("n_tokens") * float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    rest = rare_log - F.col("n_rare") * float(np.log10(model.rare_total + 0.5 * (model.rare_distinct + 1)))
    full = F.col("path_log") + rest
    return out.select(
        "doc_id", "n_tokens", (F.col("n_top") + rare_known).alias("n_known"), F.lit(int(model.total)).cast("long").alias("train_tokens"),
        base.alias("base_score"), full.alias("score"),
        F.when(F.col("n_bytes") > 0, -full / (float(np.log10(2)) * F.col("n_bytes"))).alias("bits_per_byte"),
    )
