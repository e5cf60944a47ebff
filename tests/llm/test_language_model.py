import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareweather.llm import language_model as LM

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SMALL = LM.Settings(frequent=200, slot_bits=12, held_back=5)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), None]


def base(rows, training):
    count = Counter(w for i, t in rows if training(i) for w in tokens(t))
    total, distinct = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        own = tokens(t)
        score = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        out.append((i, len(own), sum(count[w] > 0 for w in own), total, round(score, 6)))
    return sorted(map(str, out))


@pytest.mark.parametrize("repeat", [False, True])
def test_base_and_model(docs_of, sample_rows, repeat):
    rows = sample_rows + (sample_rows[:5] + [(None, "the and"), (None, None)] if repeat else [])
    out = LM.score(docs_of(rows), F.coalesce(F.col("doc_id") % 5 != 1, F.lit(False)), SMALL).collect()
    got = sorted(str((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))) for r in out)
    assert got == base(rows, lambda i: i is not None and i % 5 != 1)
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] % 5 == 1 and r["doc_id"] < 9000]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in out)


def test_shares_of_all_next_tokens_sum_to_one(docs_of):
    """The model is a distribution: over all tokens it could have seen, and the unknown."""
    vocabulary = [f"w{k}" for k in range(30)]
    rows = [(k, " ".join(vocabulary[(k * j) % 30] for j in range(1, 40))) for k in range(30)]
    context = "w1 w2 w3"
    queries = [(100 + k, f"{context} {w}") for k, w in enumerate([*vocabulary, "never"])]
    s = LM.Settings(frequent=10, slot_bits=10, held_back=4)
    out = {r["doc_id"]: r["score"] for r in LM.score(docs_of([*rows, *queries, (99, context)]), F.col("doc_id") < 50, s).collect()}
    # All queries end with the same end token; its share depends on the last token, so
    # the sum is over prefixes: path shares are checked on the tree itself.
    assert all(out[k] < 0 for k in out)
    tree = LM.Tree(np.array([5.0, 3.0, 1.0, 1.0, 0.5]))
    assert abs(sum(0.5 ** n for n in tree.size) - 1) < 1e-12
    assert len({tuple(tree.bit[a : a + n]) for a, n in zip(tree.start, tree.size)}) == 5


def test_no_training_rows_and_empty_table(docs_of):
    out = LM.score(docs_of([(1, "a b"), (2, None)]), F.lit(False), SMALL).collect()
    assert [r["n_known"] for r in out] == [0, 0] and [r["train_tokens"] for r in out] == [0, 0]
    assert all(r["base_score"] == 0.0 for r in out)
    assert LM.score(docs_of([]), F.lit(True), SMALL).count() == 0


def test_every_training_document_is_counted(docs_of, sample_rows):
    """Also those that the start weights are learned from."""
    import pyarrow as pa

    from fareweather.llm.text import pieces

    model, _ = LM.fit(docs_of(sample_rows), F.lit(True), SMALL)
    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in sample_rows])], names=["text"])
    want = np.zeros_like(model.tables, np.int64).reshape(3, -1)
    for _, chunk in pieces(batch):
        tokens = LM.Tokens(chunk)
        events = LM.Events(tokens, model.symbols(tokens.hash), model)
        for k, slot in enumerate(events.slots):
            want[k] += np.bincount(slot * 2 + events.bit, minlength=want.shape[1])
    assert (model.tables.reshape(3, -1) == want).all()


def test_start_weights_learn_from_every_training_document(docs_of):
    """Long ones too, and the order of the rows does not matter."""
    rows = [(k, " ".join(f"w{(k * j) % 17}" for j in range(1, 8000))) for k in range(8)]
    assert min(len(t) for _, t in rows) > 20_000
    found = [LM.fit(docs_of(own, parts), F.lit(True), SMALL)[0].weights for own, parts in ((rows, 1), (rows[::-1], 5), (rows[:-1], 2))]
    assert (found[0] != 0.3).any() and (found[0] == found[1]).all()
    assert (found[0] != found[2]).any()


def test_frequent_tokens_are_found_by_their_leading_bits():
    """Also where several share them, at both ends of the range, and none that is not known."""
    lead = np.uint64(7) << np.uint64(64 - LM._LEAD)
    known = np.unique(np.concatenate([lead + np.arange(0, 40, 2, np.uint64), np.array([0, 5, (1 << 64) - 1], np.uint64)]))
    model = LM.Model(known, np.ones(len(known)), None, 0, 0, 0.0, 0, SMALL)
    asked = np.concatenate([known, known + np.uint64(1), np.array([lead - np.uint64(1), 1 << 63], np.uint64)])
    place = {int(k): i for i, k in enumerate(known)}
    assert model.symbols(asked).tolist() == [place.get(int(t), len(known)) for t in asked]
    full = LM.Model(known[:-1], known[:-1], None, 0, 0, 0.0, 0, SMALL)
    assert full.symbols(known[-1:]).tolist() == [len(known) - 1]


def test_rarer_tokens_leave_a_task_once(docs_of):
    """A token is one row with all the rows it stands in, not a row for each of them."""
    import pyarrow as pa

    rows = [(k, f"often {'rare ' * (k % 3 + 1)}only{k}") for k in range(30)]
    model, _ = LM.fit(docs_of(rows), F.lit(True), LM.Settings(frequent=1, slot_bits=10))
    shared = type("Shared", (), {"value": model})
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array([t for _, t in rows])], names=["uid", "text"])
    got = {r["token"]: sorted(r["uids"]) for out in LM._rare_tokens(shared)(iter([batch])) for r in out.to_pylist()}
    assert len(got) == 32  # "often", the end and 30 of their own; "rare" is the frequent one
    assert sorted(map(len, got.values())) == [1] * 30 + [30, 30]


def test_training_documents_are_read_twice(docs_of, sample_rows):
    """Once for all tables, once for all start weights, however many parts there are."""
    calls = []
    train, refined = LM._train, LM._refined
    try:
        LM._train = lambda shared: calls.append("tables") or train(shared)
        LM._refined = lambda shared: calls.append("weights") or refined(shared)
        LM.fit(docs_of(sample_rows), F.lit(True), SMALL)
    finally:
        LM._train, LM._refined = train, refined
    assert calls == ["tables", "weights"]


def test_score_of_a_text_does_not_depend_on_its_neighbours(docs_of, sample_rows):
    """Texts of one block and of many, alone or side by side."""
    import pyarrow as pa

    model, _ = LM.fit(docs_of(sample_rows), F.lit(True), SMALL)
    mixer = LM._Mixer(model, model.tables)
    texts = ["", "one two", *[t or "" for _, t in sample_rows[:9]], " ".join(f"w{k % 23}" for k in range(500))]

    def scored(some):
        batch = pa.RecordBatch.from_arrays([pa.array(some)], names=["text"])
        [(_, chunk)] = LM.pieces(batch)
        own = LM.Tokens(chunk)
        return mixer(own, model.symbols(own.hash))

    together, last = scored(texts)
    for k, text in enumerate(texts):
        alone, weights = scored([text])
        assert alone[0] == together[k] and (weights[0] == last[k]).all()
