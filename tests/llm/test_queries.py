"""The registered queries against SQL on the smallest tables, and on empty tables."""

import os

import pytest
from oracle import connect, duck_result, spark_result

from driftlake.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_matches_sql(spark, name):
    run, sql = QUERIES[name]
    got = spark_result(run(spark, SF_DIR))
    assert got == duck_result(connect(SF_DIR), sql)
    assert got[1]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table in ("documents", "pages", "benchmark", "conversations"):
        whole = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
        whole.limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name][0](spark, str(tmp_path)).collect() == []
