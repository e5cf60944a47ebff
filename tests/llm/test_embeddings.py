import math

import numpy as np

from fareweather.llm import embeddings, store

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, n int"


def truth(rows, least=0.98):
    good = {
        i: np.array(v, np.float64) for i, v, k in rows
        if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    label = {i: k for i, _, k in rows}
    links = {i: 0 for i, *_ in rows}
    up = {i: i for i, *_ in rows}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    ids = sorted(good)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            u, v = good[a], good[b]
            if label[a] == label[b] and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= least:
                links[a] += 1
                links[b] += 1
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: (links[i], top(i), top(i) == i) for i in links}


def vectors(seed=0, size=32, groups=40):
    draw = np.random.default_rng(seed)
    rows, at = [], 0
    for _ in range(groups):
        base = draw.standard_normal(size)
        for _ in range(draw.integers(1, 9)):
            v = (base + draw.standard_normal(size) * draw.choice([0.0, 0.05, 0.12])).astype(np.float32)
            rows.append((at, [float(x) for x in v], int(draw.integers(2))))
            at += 1
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * size, 1), (903, rows[3][1], None), (904, [float("nan")] * size, 0)]
    rows += [(905, [None, *rows[4][1][1:]], 0), (906, [float("inf")] * size, 0), (907, [1.0, 2.0], 0), (908, [1.0, 2.0], 0)]
    return rows + [(950 + k, rows[0][1], 0) for k in range(5)]


def found(spark, rows, settings=embeddings.Settings()):
    store.ship(spark)
    df = spark.createDataFrame([(*r, "r", 1) for r in rows], SCHEMA).repartition(3)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_copies(df, settings).collect()}


def test_recall_and_no_false_links(spark):
    rows = vectors()
    want, got = truth(rows), found(spark, rows)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())
    assert all(got[i] == want[i] for i in (900, 901, 902, 903, 904, 905, 906, 907, 908))


def test_short_substrings_find_all_even_in_blocks(spark):
    rows = vectors(1)
    s = embeddings.Settings(table_bits=1, block=7)
    assert found(spark, rows, s) == truth(rows)


def test_recall_on_given_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label < 3").collect()]
    want, got = truth(rows), found(spark, rows)
    total = sum(w[0] for w in want.values())
    assert total > 500 and sum(g[0] for g in got.values()) >= 0.9 * total
    assert all(got[i][0] <= want[i][0] for i in want)


def test_recall_of_short_vectors_near_the_bound(spark):
    draw, rows = np.random.default_rng(5), []
    for size in (8, 16):
        for k in range(250):
            u, w = np.linalg.qr(draw.standard_normal((size, 2)))[0].T
            for v in (u, 0.9825 * u + math.sqrt(1 - 0.9825**2) * w):
                rows.append((len(rows), [float(x) for x in v.astype(np.float32)], k % 10))
    want, got = truth(rows), found(spark, rows)
    for part in (range(500), range(500, 1000)):
        assert sum(got[i][0] for i in part) >= 0.9 * sum(want[i][0] for i in part) > 400


def test_empty_table(spark):
    assert found(spark, []) == {}
