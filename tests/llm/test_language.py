import random

import pytest

from fareweather.llm import language, store

WORDS = {
    "en": "the of and with that stone river light under winter house never walking through morning",
    "de": "der und nicht mit Schule zwischen Wasser Straße heute werden unter Himmel über Morgen",
    "fr": "les avec pour dans être rivière lumière sous hiver maison jamais marcher matin était",
}


def corpus(n=40):
    import random

    draw = random.Random(4)
    rows = []
    for k in range(n):
        name = list(WORDS)[k % 3]
        rows.append((k, " ".join(draw.choice(WORDS[name].split()) for _ in range(60)), name))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    store.ship(spark)
    rows = [*corpus(), (500, None, "en"), (501, "no label at all", None), (502, "", "de")]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")


def test_held_out_accuracy_and_odd_texts(spark, labelled):
    model = language.fit(labelled.where("doc_id % 4 != 0"))
    assert set(model.names) == {"en", "de", "fr"}
    predict = language.predictor(spark, model)
    got = {r["doc_id"]: r for r in labelled.select("doc_id", "lang", predict("text").alias("p")).collect()}
    for k in range(40):
        assert got[k]["p"]["lang_pred"] == got[k]["lang"] and not got[k]["p"]["rejected"]
    for k in (500, 502):
        assert tuple(got[k]["p"]) == ("und", 0.0, 0.0, True)
    assert all(0 <= r["p"]["score"] <= 1 for r in got.values())


def test_narrow_lead_is_rejected(spark, labelled):
    model = language.fit(labelled)
    mixed = [("1234 ... !!",), ("zzqx kkw",), (WORDS["en"] + " " + "x" * 100_000,)]
    predict = language.predictor(spark, model)
    got = [r["p"] for r in spark.createDataFrame(mixed, "text string").select(predict("text").alias("p")).collect()]
    assert got[0]["lang_pred"] == "und" and got[1]["rejected"] and got[2]["lang_pred"] == "en"


def test_lead_does_not_fade_with_length(spark, labelled):
    model = language.fit(labelled)
    encode = language._Encoders(model)
    for name in WORDS:
        once = " ".join(t for _, t, own in corpus() if own == name)
        draw = random.Random(7)
        words = [w + draw.choice(["", "s", "e", "n"]) for w in once.split()]
        long = " ".join(draw.choice(words) + draw.choice("abcdefgh") * draw.randrange(3) for _ in range(400_000))
        found, _, margin, rejected = encode(long)
        assert found == name and not rejected
        assert margin > encode(long[: model.settings.block_bytes])[2] / 2


def test_every_label_is_learned(spark):
    draw = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:02d}": ["".join(draw.choices(letters, k=6)) for _ in range(30)] for k in range(70)}
    rows = [(k * 70 + j, " ".join(draw.choices(words[n], k=60)), n) for k in range(3) for j, n in enumerate(words)]
    words["long"] = ["".join(draw.choices(letters, k=6)) for _ in range(3000)]
    # Long rows only, without an id, and each word in another place of the text.
    rows += [(None, " ".join(draw.choices(words["long"][k * 1500 :][:1500], k=4000)), "long") for k in range(2)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.names) == set(words) and model.names[-1] == "long"
    assert sum(map(len, model.contents)) <= model.settings.all_bytes
    encode = language._Encoders(model)
    for name, own in words.items():
        found, _, _, rejected = encode(" ".join(draw.choices(own, k=200)))
        assert found == name and not rejected


def test_dictionaries_share_their_bytes(spark, labelled):
    s = language.Settings(all_bytes=900)
    model = language.fit(labelled, settings=s)
    assert len(model.names) == 3 and max(map(len, model.contents)) <= 300
    assert all(len(c) > 100 for c in model.contents)


def test_fit_is_bounded_and_repeatable(labelled):
    s = language.Settings(languages=2, rows=3, dictionary_bytes=200)
    one, two = language.fit(labelled, settings=s), language.fit(labelled.repartition(7), settings=s)
    assert one.contents == two.contents and len(one.names) == 2 and max(map(len, one.contents)) <= 200


def test_empty_tables(spark, labelled):
    empty = labelled.limit(0)
    model = language.fit(empty)
    assert model.names == ()
    assert empty.select(language.predictor(spark, model)("text")).count() == 0
    got = labelled.select(language.predictor(spark, model)("text").alias("p")).first()["p"]
    assert got["lang_pred"] == "und" and got["rejected"]


def test_held_out_rows_by_id(spark):
    import zlib

    df = spark.range(50).toDF("doc_id").withColumn("h", language.held_out(4, 2))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in df.collect())
