import hashlib

import numpy as np
import pytest

from fareweather.llm import store, vector_codes
from fareweather.llm.vector_codes import Codebooks, Settings

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, vector string"


def brute(rows, parts, entries, rounds):
    """The contract, one vector at a time."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [[list(e) for e in book] for book in books]
        for p in range(parts):
            own = [nearest(v, p)[1] for _, v, _ in kept]
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), o in zip(kept, own) if o == k]
                if mine:
                    new[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
        books = new
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, y in kept:
        found = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), y))
    total = {}
    for *_, e, y in out:
        total[y] = total.get(y, 0) + e
    return sorted(((i, c, e, total[y], sha) for i, c, e, y in out), key=str)


@pytest.fixture(scope="module")
def frame(spark):
    store.ship(spark)
    return lambda rows: spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def hostile(seed):
    draw = np.random.default_rng(seed)
    # Coarse values, so that many parts lie at equal distances.
    rows = [(int(i), (draw.integers(-3, 4, 8) / 256 * (1 + i % 3)).tolist(), int(i % 4) if i % 5 else None) for i in draw.permutation(120)]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1], 1), (None, rows[3][1], 2), (None, None, None)]
    rows += [(500, None, 1), (501, [None] * 8, 1), (502, [float("nan")] + [0.0] * 7, 1), (503, [float("inf")] * 8, 2), (504, [0.0] * 8, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(frame, seed):
    rows = hostile(seed)
    s = Settings(parts=4, entries=12, splits=3, leaf=2)
    got = vector_codes.compress(frame(rows), s).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 4, 12, 2)
    shuffled = vector_codes.compress(frame(rows).repartition(7), Settings(parts=4, entries=12, broadcast_labels=1)).collect()
    assert sorted(map(tuple, shuffled), key=str) == brute(rows, 4, 12, 2)


def test_tree_is_exact_and_leaves_entries_out():
    draw = np.random.default_rng(5)
    centres = draw.integers(-4000, 4000, (12, 4))
    entries = (centres[draw.integers(0, 12, 64)] + draw.integers(-60, 60, (64, 4)))[None]
    vectors = centres[draw.integers(0, 12, 3000)] + draw.integers(-80, 80, (3000, 4))
    books = Codebooks(entries, Settings(parts=1))
    code, error = books.assign(vectors)
    square = ((vectors[:, None] - entries[0][None]) ** 2).sum(axis=2)
    assert (error[:, 0] == square.min(axis=1)).all() and (code[:, 0] == square.argmin(axis=1)).all()
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    taken = books.trees[0].search(vectors, np.arange(len(vectors)), best, best.copy())
    assert taken < 0.6 * square.size


def test_repeated_entries_go_to_the_lower_index():
    entries = np.zeros((1, 40, 4), np.int64)
    code, error = Codebooks(entries, Settings(parts=1)).assign(np.array([[0, 0, 0, 0], [1, -1, 2, 0]]))
    assert code[:, 0].tolist() == [0, 0] and error[:, 0].tolist() == [0, 6]


def test_few_rows_empty_tables_and_odd_lengths(frame):
    assert vector_codes.compress(frame([(1, None, 1)])).count() == 0
    rows = [(7, [0.5] * 32, 1), (3, [1e30, -1e30] + [0.0] * 30, 1), (4, [0.5] * 3, 1), (9, [], 1)]
    got = {r["vec_id"]: r for r in vector_codes.compress(frame(rows)).collect()}
    assert set(got) == {3, 7} and got[7]["error"] == 0 and got[7]["label_error"] == 0 and got[3]["code"] == "00" * 16
    assert vector_codes.compress(frame([(1, [0.5] * 3, 1)])).count() == 0
