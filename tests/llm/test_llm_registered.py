"""Every registered query of the subpackage: DuckDB SQL where there is some."""

import duckdb
import pytest

import corpus_pipeline
from ledgerlens.llm.oracle import ORACLE_SQL
from ledgerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def values(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name]).df()
    assert sorted(want.columns) == columns
    cols = ", ".join(f'"{c}"' for c in columns)
    rows = con.execute(f"SELECT {cols} FROM ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=key) == sorted(rows, key=key)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "embeddings", "pages", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    full = QUERIES[name](spark, SF)
    empty = QUERIES[name](spark, str(tmp_path))
    assert empty.count() == 0
    assert empty.dtypes == full.dtypes


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert len(corpus_pipeline.STAGES) == 5
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        if i < 4:
            assert docs.columns == columns
            if i < 2:
                assert 0 < len(rows) <= before
                before = len(rows)
            docs = spark.createDataFrame(rows, docs.schema)
    assert docs.columns == ["doc_id", "source", "n_tokens", "ids"]
    assert all(len(r.ids) == r.n_tokens for r in rows)
