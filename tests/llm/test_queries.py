"""The registered queries over whole tables, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from fareweather.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op2_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op3_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op4_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_ngram_join": {"doc_id", "n_shingles", "component_id"},
    "op6_language_model": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op7_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op8_embeddings": {"vec_id", "n_links", "component_id", "kept"},
    "op9_decontamination": {"doc_id", "item_id", "coverage"},
    "op10_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op11_vector_codes": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
    "op12_ranked_search": {"item_id", "rank", "doc_id", "score"},
    "op13_quality": {"doc_id", "held_out", "score", "predicted"},
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(driver.queries()) >= {*COLUMNS, "pipeline"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, small, name):
    df = QUERIES[name](spark, small)
    assert COLUMNS[name] <= set(df.columns)
    rows = df.count()
    given = 500 if name.startswith(("op8", "op11")) else 200
    assert rows == given or name.startswith(("op3", "op9", "op12"))


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_those_of_sql(spark, small, name):
    import duckdb

    with duckdb.connect() as con:
        for table in ("documents", "embeddings", "benchmark"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
        found = con.execute(SQL[name])
        names = [d[0] for d in found.description]
        want = sorted(found.fetchall(), key=str)
    assert sorted(map(tuple, QUERIES[name](spark, small).select(*names).collect()), key=str) == want and want


def test_pipeline_stages(spark, small):
    docs = given = spark.read.parquet(f"{small}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store.written(stage(spark, docs, small), "test")
        assert docs.columns == given.columns
        kept.append(docs.count())
    assert 180 <= kept[0] <= 200 and kept[0] > kept[1] >= kept[2] == kept[3] > 150
    assert docs.where("text rlike '@mail[0-9]'").count() == 0
    pieces = corpus_pipeline.packed(spark, docs, small)
    assert pieces.select("doc_id").distinct().count() == kept[3]


def test_pipeline_on_an_empty_table(spark, small, tmp_path):
    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
