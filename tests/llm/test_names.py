"""Stages keep columns whose names the operators use inside."""

from fareweather.llm import decontamination, ngram_join, pii


def test_clashing_columns_stay_as_they_are(spark):
    text = "write to anna.berg@example.org about the plan of the new garden by the old river bank"
    names = ["_uid", "_UID_", "_spans", "_kept", "uid", "token", "point", "component"]
    rows = [(k, f"{text} number {k % 2} and some more words of no use", *[f"{n}{k}" for n in names]) for k in range(4)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *[n if n.lower() != "_uid_" else "_uid_x" for n in names]])
    items = spark.createDataFrame([(1, "nothing of the kind stands in any of these rows at all")], "item_id long, text string")
    for stage, kept in ((ngram_join.one_of_each, 2), (lambda d: decontamination.clean(d, items), 4), (pii.redacted, 4)):
        got = stage(docs)
        assert got.columns == docs.columns
        found = [tuple(r)[2:] for r in got.collect()]
        assert len(found) == kept and set(found) <= {r[2:] for r in rows}
    assert all("[email]" in r["text"] for r in pii.redacted(docs).collect())
