import pytest

from fareweather.llm import store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, token int, label string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with columns whose names the operators use inside."""
    store.ship(spark)

    def make(rows, parts=3):
        full = [(i, t, "en", "s", len(t or ""), "u", 1, "l") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def sample_rows(spark, small):
    """Some whole documents of the smallest table, with hostile ones."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    long = " ".join(t for _, t in rows[:12])
    return [
        *rows, (9001, None), (9002, ""), (9003, "   \n\t"), (9004, "word"), (9005, "two words"), (9006, long),
        (9007, long.replace("the", "teh", 1)), (9008, "a" * 5000), (9009, "of " * 3000), (9010, rows[5][1]),
    ]
