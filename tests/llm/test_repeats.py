import hashlib
import random
import re
from collections import Counter

import pytest

from fareweather.llm import substring_dedup, suffix_dedup
from fareweather.llm.anchors import Scheme

FEW_BYTES = Scheme(length=24, span=3, rates=(9, 3), cuts=(8, 15))
FEW_WORDS = Scheme(length=6, span=2, rates=(4, 2), cuts=(2, 4))


def byte_truth(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        hit = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                hit[k : k + length] = b"\1" * length
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out.append((i, len(b), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def word_truth(rows, length):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    order = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, float("inf")), order(i))
    out = []
    for i, w in split:
        hit = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < order(i):
                hit[k : k + length] = [True] * length
        kept = " ".join(x for x, h in zip(w, hit) if not h)
        out.append((i, len(w), sum(hit), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(str, out))


def byte_rows(docs, scheme):
    got = suffix_dedup.deduplicate(docs, scheme, digest=True).collect()
    return sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]).decode())) for r in got)


def word_rows(docs, scheme, **more):
    got = substring_dedup.deduplicate(docs, scheme, digest=True, **more).collect()
    return sorted(str((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode())) for r in got)


def mosaic(seed, rows=60):
    """Texts put together from a few shared passages, cut at random places."""
    draw = random.Random(seed)
    words = ["ab", "c", "de", "fgh", "é", "the", "x" * 9]
    passages = [" ".join(draw.choice(words) for _ in range(40)) for _ in range(5)]
    out = []
    for i in range(rows):
        text = ""
        for _ in range(draw.randrange(6)):
            p = draw.choice(passages)
            a = draw.randrange(len(p))
            text += p[a : a + draw.randrange(90)] + draw.choice(["", " ", "z", "\n"])
        out.append((i, text))
    return out + [(900, None), (901, "aaaaaaaa" * 40), (902, "aaaaaaaa" * 40), (903, "ab " * 50), (904, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(docs_of, seed):
    rows = mosaic(seed)
    assert byte_rows(docs_of(rows), FEW_BYTES) == byte_truth(rows, 24)


@pytest.mark.parametrize("seed", [3, 4])
def test_words_against_brute_force(docs_of, seed):
    rows = mosaic(seed)
    assert word_rows(docs_of(rows), FEW_WORDS) == word_truth(rows, 6)
    assert word_rows(docs_of(rows), FEW_WORDS, states=20) == word_truth(rows, 6)


@pytest.mark.parametrize("seed", [3, 6])
def test_hot_keys_against_brute_force(docs_of, seed):
    rows = [*mosaic(seed), *mosaic(seed, 20)[3:9], (None, mosaic(seed)[2][1])]
    assert word_rows(docs_of(rows), FEW_WORDS, hot=1) == word_truth(rows, 6)
    assert word_rows(docs_of(rows), FEW_WORDS, hot=12) == word_truth(rows, 6)


def test_hot_key_meets_no_automaton(docs_of, monkeypatch):
    """A passage with another context in each document: one row a window leaves a batch."""
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(k, f"a{k} b{k} c{k} {passage} d{k} e{k} f{k}") for k in range(300)]
    inner = substring_dedup._stream

    def watched(length, states):
        run = inner(length, states)

        def counted(batches):
            for batch in batches:
                sizes = [len(w) for w in batch.column("words").to_pylist()]
                assert sum(n > 1 for n in sizes) <= 100, "stretches of a hot key in one task"
                yield from run([batch])

        return counted

    monkeypatch.setattr(substring_dedup, "_stream", watched)
    got = word_rows(docs_of(rows, 1), FEW_WORDS, hot=20)
    assert got == word_truth(rows, 6)


def test_production_windows(docs_of, sample_rows):
    rows = sample_rows[:40] + sample_rows[-10:]
    assert byte_rows(docs_of(rows), suffix_dedup.BYTES) == byte_truth(rows, 200)
    assert word_rows(docs_of(rows), substring_dedup.WORDS) == word_truth(rows, 50)


def test_repeated_rows_and_missing_ids(docs_of):
    rows = [*mosaic(5, 20), *mosaic(5, 20)[3:9], (None, mosaic(5)[2][1]), (None, "a b c d e f g " * 9)]
    assert byte_rows(docs_of(rows), FEW_BYTES) == byte_truth(rows, 24)
    assert word_rows(docs_of(rows), FEW_WORDS) == word_truth(rows, 6)


def test_kept_bytes_and_spans(docs_of):
    shared = "0123456789" * 3
    rows = [(1, "left " + shared + " right"), (2, shared)]
    got = {r["doc_id"]: r for r in suffix_dedup.deduplicate(docs_of(rows), FEW_BYTES).collect()}
    assert bytes(got[1]["kept"]) == b"left  right" and (got[1]["starts"], got[1]["ends"]) == ([5], [35])
    assert bytes(got[2]["kept"]) == b""


def test_texts_are_shuffled_once(docs_of):
    """The stretches looked at one by one and the last join take the same shuffled texts."""
    rows = mosaic(7)
    done = suffix_dedup.deduplicate(docs_of(rows), FEW_BYTES, digest=True)
    assert len(done.collect()) == len(rows)
    plan = done._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert re.search(r"ReusedExchange \[[^]]*\btext#[^]]*\], Exchange hashpartitioning\(uid#", plan), plan


def test_empty_tables(docs_of):
    assert suffix_dedup.deduplicate(docs_of([])).count() == 0
    assert substring_dedup.deduplicate(docs_of([])).count() == 0
