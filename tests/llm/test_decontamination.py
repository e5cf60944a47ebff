import random

import numpy as np
import pytest

from fareweather.llm import decontamination as D

SPARSE = D.Settings(broadcast_tokens=0)


def words(draw, n, kinds=400):
    return [f"w{draw.randrange(kinds)}" for _ in range(n)]


@pytest.fixture(scope="module")
def tables(spark, docs_of):
    draw = random.Random(1)
    items = [(k, " ".join(words(draw, draw.randrange(14, 50)))) for k in range(30)]
    items += [(100, "Short one"), (101, ""), (102, None), (103, items[0][1])]
    rows = []
    for k in range(120):
        own = words(draw, draw.randrange(20, 200))
        kind = k % 6
        leak = items[k % 30][1].split()
        if kind == 1:
            own[5:5] = leak
        elif kind == 2:  # the second half before the first
            half = len(leak) // 2
            own[3:3] = [*leak[half:], "x", *leak[:half]]
        elif kind == 3:
            own[2:2] = leak[: len(leak) // 3]
        elif kind == 4:
            own[9:9] = [w.upper() + "," for w in leak]
        rows.append((k, " ".join(own)))
    rows += [(900, None), (901, ""), (902, "a SHORT, one."), (903, items[3][1] + " " + items[4][1]), (1, rows[1][1])]
    return rows, items, docs_of(rows), spark.createDataFrame([(*r, "t") for r in items], "item_id long, text string, coverage string")


def slow_tiles(item, doc, least):
    """Greedy tiling by trying every pair of places again and again."""
    used_i, used_d, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and p + n not in used_i and t + n not in used_d:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return total
        used_i.update(range(p, p + n))
        used_d.update(range(t, t + n))
        total += n


def test_against_brute_force(tables):
    import re

    rows, items, docs, bench = tables
    cut = lambda t: re.findall(r"[A-Za-z0-9\x80-￿]+", (t or "").lower())
    want = []
    for i, t in rows:
        doc = cut(t)
        have = set(doc)
        for k, text in items:
            item = cut(text)
            if item and len(have & set(item)) >= 0.6 * len(set(item)):
                covered = slow_tiles(item, doc, min(5, len(item)))
                if covered >= 0.6 * len(item):
                    want.append((i, k, covered))
    got = sorted((r["doc_id"], r["item_id"], r["covered"]) for r in D.leaks(docs, bench).collect())
    assert got == sorted(want)
    assert {k for k, _, _ in got} >= {k for k in range(120) if k % 6 in (1, 2, 4)} | {902, 903}
    joined = sorted((r["doc_id"], r["item_id"], r["covered"]) for r in D.leaks(docs, bench, SPARSE).collect())
    assert joined == got


def test_clean_keeps_the_rest_with_all_columns(tables):
    rows, _, docs, bench = tables
    left = D.clean(docs, bench)
    assert left.columns == docs.columns
    kept = {r["doc_id"] for r in left.collect()}
    assert {900, 901} | {k for k in range(120) if k % 6 in (0, 3, 5)} == kept


def test_clean_without_ids_and_with_repeated_ids(tables, docs_of):
    _, items, _, bench = tables
    leak, clean = items[0][1], " ".join(f"c{k}" for k in range(30))
    rows = [(None, leak), (None, clean), (7, leak), (7, clean + " x"), (8, clean), (9, leak), (9, leak)]
    for s in (D.Settings(), SPARSE):
        left = D.clean(docs_of(rows), bench, s)
        assert left.columns == docs_of(rows).columns
        got = sorted((str(r["doc_id"]), r["text"]) for r in left.collect())
        assert got == sorted([("None", clean), ("7", clean + " x"), ("8", clean)])


def test_tiles_take_the_longest_first():
    item = np.array([1, 2, 3, 4, 5, 6, 7], np.uint64)
    doc = np.array([4, 5, 6, 7, 9, 1, 2, 3, 4, 5], np.uint64)
    seeds = [(p, t) for p in range(6) for t in range(9) if (item[p : p + 2] == doc[t : t + 2]).all()]
    assert sorted(D.tiles(item, doc, 2, seeds)) == [(0, 5, 5), (5, 2, 2)]


def test_empty_tables(spark, docs_of, tables):
    _, _, docs, bench = tables
    assert D.leaks(docs_of([]), bench).count() == 0
    assert D.leaks(docs, bench.limit(0)).count() == 0
    assert D.leaks(docs, bench.limit(0), SPARSE).count() == 0
