import random
from dataclasses import replace

import numpy as np
import pytest

from fareweather.llm import store, toxicity

BAD = ["scum", "idiotic", "worthless"]
NEUTRAL = [f"word{k}" for k in range(60)]


@pytest.fixture(scope="module")
def tables(spark):
    """Toxic texts name one group far more often, though the term is neutral."""
    store.ship(spark)
    draw = random.Random(2)
    rows = []
    for k in range(400):
        toxic = k % 4 == 0
        own = draw.choices(NEUTRAL, k=12)
        if toxic:
            own[draw.randrange(12)] = draw.choice(BAD)
        if draw.random() < (0.5 if toxic else 0.03):
            own[0] = "muslims"
        elif draw.random() < 0.2:
            own[0] = "christians"
        rows.append((k, " ".join(own), int(toxic)))
    docs = [(k, t, "x", 1) for k, t, _ in rows] + [(900, None, "x", 1), (901, "", "x", 1), (0, rows[0][1], "x", 1)]
    labels = [(k, y, 0) for k, _, y in rows] + [(900, 0, 0), (901, None, 0), (None, 1, 0), (7777, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, features string, toxic int").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic int, quality int"),
    )


def test_learns_words_and_scores_all(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where("doc_id % 5 != 0 or doc_id is null"))
    score = toxicity.scorer(spark, model)
    got = [(r["doc_id"], r["s"]) for r in docs.select("doc_id", score("text").alias("s")).collect()]
    assert len(got) == 403 and all(0 <= s <= 1 for _, s in got)
    held = [(k, s) for k, s in got if k % 5 == 0 and k < 400]
    assert sum((s >= 0.5) == (k % 4 == 0) for k, s in held) >= 0.97 * len(held)


def test_penalty_takes_the_weight_off_the_group(tables):
    docs, labels = tables
    texts = ["muslims word1 word2", "christians word1 word2"]
    plain = toxicity.score_texts(texts, toxicity.fit(docs, labels, toxicity.Settings(penalty=0.0, signal=2.0)))
    fair = toxicity.score_texts(texts, toxicity.fit(docs, labels, toxicity.Settings(penalty=50.0, signal=2.0)))
    assert abs(plain[0] - plain[1]) > 3 * abs(fair[0] - fair[1])
    assert fair[0] < 0.5


def test_repeatable_and_bounded(tables):
    docs, labels = tables
    s = replace(toxicity.Settings(), rows=100)
    one, two = toxicity.fit(docs, labels, s), toxicity.fit(docs.repartition(5), labels.repartition(4), s)
    assert (one.features == two.features).all() and np.allclose(one.weights, two.weights)


def test_without_labels(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score_texts(["any", None], model).tolist() == [0.5, 0.5]
    assert docs.limit(0).select(toxicity.scorer(spark, model)("text")).count() == 0


def test_scores_equal_brute_force(spark, tables):
    """Each score from the single words of the whole text, one at a time."""
    import math
    import re

    docs, labels = tables
    model = toxicity.fit(docs, labels, toxicity.Settings(signal=2.0))
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))

    def by_hand(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = set(re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low))
        found = set()
        for word in words:
            found.update(toxicity._features(toxicity.Words(toxicity._chunk([word.encode()]), True, toxicity.SIGNS), model.settings)[0].tolist())
        return 1 / (1 + math.exp(-(model.bias + sum(weight.get(f, 0.0) for f in found))))

    texts = [r["text"] for r in docs.limit(60).collect()] + ["SCUM, scum! Ünd word1\n" * 400, "?!", "idiotic\x00worthless"]
    got = toxicity.score_texts(texts, model)
    assert np.allclose(got, [by_hand(t) for t in texts], atol=1e-12) and len(weight) > 5
