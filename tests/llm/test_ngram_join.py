import random
import re
from collections import Counter, defaultdict

from fareweather.llm import ngram_join
from fareweather.llm.components import components

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def truth(rows, percent=90, n=3):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(m for g in sets[i] for m in holders[g])
        for m, c in common.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[m]) - c):
                a, b = top(i), top(m)
                up[max(a, b)] = min(a, b)
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def rows_of(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def variants(seed, copies=50, words=200):
    """Near copies of one text, on both sides of the threshold, and chains of them."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(3000)}" for _ in range(words)]
    out, last = [], base
    for i in range(copies):
        new = list(draw.choice([base, last]))
        for _ in range(draw.randrange(7)):
            new[draw.randrange(words)] = f"v{draw.randrange(5)}"
        out.append((i * 3, " ".join(new)))
        last = new
    draw.shuffle(out)
    return out


def test_against_brute_force(docs_of, sample_rows):
    rows = [*sample_rows, *[(20_000 + i, t) for i, t in variants(1)], (30_001, "One TWO"), (30_002, "one two"), (30_003, "two one")]
    assert rows_of(ngram_join.near_copies(docs_of(rows))) == truth(rows)


def test_other_settings(docs_of):
    rows = variants(2, 80, 60)
    s = ngram_join.Settings(percent=70, words=2, groups=3, fine_groups=7, slots=1 << 14, leaf=2)
    assert rows_of(ngram_join.near_copies(docs_of(rows), s)) == truth(rows, 70, 2)


def test_tree_never_misses():
    import numpy as np

    draw = np.random.default_rng(3)
    points = draw.poisson(3, (300, 8))
    sizes = points.sum(axis=1)
    tree = ngram_join.Tree(points, sizes, 4)
    for k in range(0, 300, 7):
        overlap = np.minimum(points, points[k]).sum(axis=1)
        want = np.flatnonzero((overlap * 100 >= 60 * (sizes + sizes[k] - overlap)) & (sizes * 60 <= 100 * sizes[k]) & (sizes * 100 >= 60 * sizes[k]))
        assert set(want) <= set(tree.near(k, 60).tolist())


def test_one_of_each_keeps_columns_and_rows_without_id(docs_of):
    rows = [(1, "a b c d"), (2, "A b c d"), (3, None), (None, "x y z"), (None, "x y z"), (4, ""), (1, "a b c d")]
    docs = docs_of(rows)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(str((r["doc_id"], r["text"])) for r in kept.collect())
    assert len(got) == 4 and str((3, None)) in got and str((4, "")) in got and str((None, "x y z")) in got
    unique = ngram_join.one_of_each(docs_of([(1, "a b c d"), (2, "A b c d"), (3, None)]))
    assert sorted(r["doc_id"] for r in unique.collect()) == [1, 3]


def test_empty_table(docs_of):
    assert ngram_join.near_copies(docs_of([])).count() == 0


def test_components_of_chains_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {(r["node"], r["component"]) for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(100, 100), (101, 100), (200, 150), (150, 150)}


def test_components_of_stars_take_one_round(spark, monkeypatch):
    """Nothing is written again that a round did not change, nor in more files than rows are worth."""
    from fareweather.llm import store

    tables, written = [], store.written
    monkeypatch.setattr(store, "written", lambda df, name: tables.append(written(df, name)) or tables[-1])
    stars = spark.createDataFrame([(10 * (k % 7), 10 * (k % 7) + 1 + k // 7) for k in range(63)], "a long, b long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["node"]: r["component"] for r in components(stars).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {10 * k + i: 10 * k for k in range(7) for i in range(10)}
    assert len(tables) == 2 and len(tables[-1].inputFiles()) <= 12
