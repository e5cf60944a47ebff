import random
from dataclasses import replace

import numpy as np
import pytest

from fareweather.llm import quality, store

WORDS = [f"word{k}" for k in range(80)]


def made(n, seed):
    """Prose, and three kinds of junk: repeats, signs at words, capitals."""
    draw, rows = random.Random(seed), []
    for k in range(n):
        own = draw.choices(WORDS, k=draw.randrange(8, 60))
        kind = k % 8
        if kind == 0:
            own = own[:3] * 12
        elif kind == 1:
            own = [w + draw.choice(["###", "$$$"]) for w in own]
        elif kind == 2:
            own = [w.upper() + "!!" for w in own]
        rows.append((k, " ".join(own).capitalize() if kind > 2 else " ".join(own), int(kind > 2)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    store.ship(spark)
    rows = made(640, 3)
    docs = [(k, t, len(t), "x", 1) for k, t, _ in rows]
    docs += [(900, None, None, "x", 1), (901, "", 0, "x", 1), (0, rows[0][1], -5, "x", 1), (902, " ".join(WORDS * 3000), 7, "x", 1), (None, "a b", 3, "x", 1)]
    labels = [(k, y, 0) for k, _, y in rows] + [(900, 0, 0), (901, None, 0), (None, 1, 0), (7777, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, n_chars long, features string, quality int").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_learns_structure_and_scores_all(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels.where("doc_id % 5 != 0 or doc_id is null"))
    score = quality.scorer(spark, model)
    got = [(r["doc_id"], r["s"]) for r in docs.select("doc_id", score("text", quality.stated_length(docs)).alias("s")).collect()]
    assert len(got) == 645 and all(0 <= s <= 1 for _, s in got)
    held = [(k, s) for k, s in got if k is not None and k % 5 == 0 and k < 640]
    assert sum((s >= 0.7) == (k % 8 > 2) for k, s in held) >= 0.97 * len(held)


def test_held_out_accuracy_on_given_rows(spark):
    from fareweather.llm.queries import op13_quality

    folder = "/root/testdata/sf0.01"
    scored = op13_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    rows = scored.select("quality", "predicted").collect()
    assert len(rows) > 50 and sum(r["quality"] == r["predicted"] for r in rows) >= 0.95 * len(rows)


def test_no_labels_and_empty_tables(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels.where("false"))
    assert [r[0] for r in docs.limit(2).select(quality.scorer(spark, model)("text", quality.stated_length(docs))).collect()] == [0.5, 0.5]
    none = docs.where("false")
    assert none.select(quality.scorer(spark, quality.fit(none, labels))("text", quality.stated_length(none))).count() == 0
    # A table without stated lengths, and one that states them as text.
    plain = docs.drop("n_chars")
    assert quality.fit(plain, labels, quality.Settings(rows=40, moves=1)).weights.any()
    odd = docs.selectExpr("doc_id", "text", "'about ten' AS n_chars")
    assert odd.select(quality.stated_length(odd)).distinct().collect()[0][0] is None


def test_repeatable_and_bounded(tables):
    docs, labels = tables
    s = replace(quality.Settings(), rows=100, moves=3)
    one, two = quality.fit(docs, labels, s), quality.fit(docs.repartition(5), labels.repartition(4), s)
    assert (one.weights == two.weights).all() and (one.vectors == two.vectors).all()


def test_linear_time_identity_equals_all_pairs():
    draw = np.random.default_rng(1)
    n = len(quality.FIGURES)
    count = np.array([n + 3, n, n + 7])
    feature = draw.integers(0, 50, count.sum())
    weights, vectors = draw.normal(size=50), draw.normal(size=(50, 4))
    z, x, _, _ = quality._raw(feature, count, 0.3, weights, vectors)
    at = 0
    for k, c in enumerate(count):
        f, v = feature[at : at + c], x[at : at + c]
        pairs = sum(vectors[f[i]] @ vectors[f[j]] * v[i] * v[j] for i in range(c) for j in range(i))
        assert np.isclose(z[k], 0.3 + weights[f] @ v + pairs)
        at += c
