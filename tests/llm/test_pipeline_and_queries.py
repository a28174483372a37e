import duckdb
import pytest
from check import TABLES, rows
from conftest import FOLDER

import corpus_pipeline
from quillbook.llm.queries import ORACLE, QUERIES
from test_line_dedup import expected, key
from test_near_duplicates import brute


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    documents = database.execute("select count(*) from documents").fetchone()[0]
    if name in ORACLE:
        assert rows(found) == rows(database.execute(ORACLE[name]).df())
    if name not in ("op2_decontamination", "op4_packing", "op8_chat_format", "op11_vector_codes"):
        assert len(found) == documents == found["doc_id"].nunique()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    """Each stage against brute force on what the one before it kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER)
        if name == "packing":
            assert {r["doc_id"] for r in found.select("doc_id").distinct().collect()} == set(kept)
            break
        assert found.columns == columns
        result = {r["doc_id"]: r["text"] for r in found.collect()}
        if name == "language":
            assert len(result) >= 0.98 * len(kept)
        elif name == "line dedup":
            wanted = expected(list(kept.items()), 10, "first")
            assert result == {i: t for i, t in wanted if t == kept[i] or any(key(x) for x in t.split("\n"))}
        elif name == "near dedup":
            groups = brute(list(kept.items()), 5)
            assert result == {i: t for i, t in kept.items() if groups[i][1] == i}
        else:
            assert set(kept) - set(result) == {i for i, t in kept.items() if any(x in t for x in items)}
        docs = spark.createDataFrame(found.collect(), found.schema)
        kept = result


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line dedup", "near dedup", "decontamination", "packing"]


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
