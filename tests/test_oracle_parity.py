"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from fieldlens.sources.tables import TABLES

ROOT = "/root/testdata/sf0.001"


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{round(v, 6):.6f}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, str(v))


def canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ROOT}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "report_date" in df.columns


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


#: Queries that SQL cannot express, with the tests that hold them against brute force or definitions.
NO_SQL = {
    "op2_hash_prefix_forest": "tests/llm/test_data_ops.py",
    "op3_language_id": "tests/llm/test_text_ops.py",
    "op5_simhash_near_dedup": "tests/llm/test_text_ops.py",
    "op6_wrapper_extraction": "tests/llm/test_data_ops.py",
    "op8_recurrent_lm_scores": "tests/llm/test_text_ops.py",
    "op9_personal_data": "tests/llm/test_text_ops.py",
    "op11_token_alignment": "tests/llm/test_alignment.py",
    "pipeline": "tests/llm/test_data_ops.py",
}


def test_queries_without_sql_are_listed():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.queries()) - set(E.oracle_sql()) <= set(NO_SQL)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, ROOT)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    types = {d[0]: DUCK_TO_SPARK.get(str(d[1]), str(d[1])) for d in cur.description}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    assert got == canon(cols, cur.fetchall())
