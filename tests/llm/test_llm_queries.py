"""Every registered query of this subpackage against its SQL, or its shape, over whole tables."""

import duckdb
import pytest

from chatterscope.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, database, name):
    want = database.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    want, got = (x[columns].sort_values(columns, ignore_index=True) for x in (want, got))
    assert want.equals(got.astype(want.dtypes.to_dict()))


# Compared with brute force in their own files.
ROWS_OF_OTHER_KINDS = {"op11_turns", "op13_packing"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - ROWS_OF_OTHER_KINDS))
def test_one_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    ids = sorted(r["doc_id"] for r in got.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in documents.select("doc_id").collect())


def test_thirteen_operators():
    assert sorted({int(n.split("_")[0][2:]) for n in QUERIES}) == list(range(1, 14))
