import math
import random
import re

import numpy as np
import pytest

from fareweather.llm import ranked_search
from fareweather.llm.ranked_search import Lists, Search, Settings

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, best=50):
    held = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = {}
    for _, own in held:
        for t in set(own):
            df[t] = df.get(t, 0) + 1
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    for i, own in asked.items():
        scored = []
        for d, words in held:
            m = 50 + (50 * len(words) * n_docs) // total if total else 0
            score = sum(weight[t] * ((10**9 * words.count(t)) // (1000 * words.count(t) + 20 * m)) for t in own & set(words))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -x) for r, (x, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:best], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame([(i, t, "t", 1) for i, t in rows], "item_id long, text string, term string, query int").repartition(2)


def rows_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_brute_force_on_given_and_hostile_rows(spark, docs_of, items_of, small, sample_rows):
    docs = [*sample_rows, (None, sample_rows[3][1]), (sample_rows[4][0], sample_rows[4][1]), (9100, "ÄRGER Ärger ärger\x00naïve-naïve")]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()][:12]
    items += [(900, None), (901, ""), (902, "?!"), (903, "nowhereatall"), (904, "Ärger naïve THE"), (None, "the of and"), (0, "of"), (0, None)]
    want = brute(docs, items)
    assert rows_of(ranked_search.search(docs_of(docs), items_of(items))) == want
    # Small blocks, leaves and turns take the other ways and give the same rows.
    s = Settings(postings=300, leaf=1, terms=150, turns=3)
    assert rows_of(ranked_search.search(docs_of(docs), items_of(items), s)) == want


def test_ties_and_copies_go_by_id(docs_of, items_of):
    docs = [(k, "red green") for k in range(300, 0, -1)] + [(k, "red red blue") for k in range(301, 340)] + [(500, "blue")]
    items = [(1, "red"), (2, "green blue"), (3, "red green blue")]
    for s in (Settings(best=7), Settings(best=7, leaf=1, postings=100), Settings(best=400)):
        assert rows_of(ranked_search.search(docs_of(docs, 5), items_of(items), s)) == brute(docs, items, s.best)


def test_empty_tables(docs_of, items_of):
    assert rows_of(ranked_search.search(docs_of([]), items_of([(1, "a")]))) == []
    assert rows_of(ranked_search.search(docs_of([(1, None), (2, " . ")]), items_of([(1, "a")]))) == []
    assert rows_of(ranked_search.search(docs_of([(1, "a")]), items_of([]))) == []


def test_bounds_leave_documents_out():
    """A rare term of high impact: most documents are never scored."""
    draw = random.Random(4)
    n = 20_000
    term, doc, impact = [], [], []
    for d in range(n):
        for t in {0, draw.randrange(1, 6)}:
            term.append(t), doc.append(d), impact.append(draw.randrange(1, 40))
    for d in draw.sample(range(n), 60):
        term.append(7), doc.append(d), impact.append(draw.randrange(900, 1000))
    lists = Lists(*map(np.array, (term, doc, impact)), n, 9)
    search = Search(lists, np.arange(n), np.array([0, 1, 7, 8]), Settings(best=50, leaf=8))
    got = search.run([])
    score = np.zeros(n, int)
    for t, d, x in zip(term, doc, impact):
        score[d] += x if t in (0, 1, 7) else 0
    want = sorted(((int(x), d) for d, x in enumerate(score) if x), key=lambda r: (-r[0], r[1]))[:50]
    assert got == want and search.scored < n / 10


def test_range_maxima():
    draw = np.random.default_rng(3)
    term, doc = np.repeat(np.arange(5), 100), np.tile(np.arange(100), 5)
    lists = Lists(term, doc, draw.integers(0, 50, 500), 100, 5)
    a = draw.integers(0, 99, 200)
    b = np.array([draw.integers(x + 1, 101) for x in a])
    top = lists.largest(a + 200, b + 200)
    assert all(lists.impact[t] == lists.impact[200 + x : 200 + y].max() for t, x, y in zip(top, a, b))
