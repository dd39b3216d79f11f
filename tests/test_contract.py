"""The driver contract, and a few queries against their SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import TABLES, canonical
from ledger_queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "q_vague_row_values q_vague_time_of_day q_number_suffix q_list_charset_delim q_rules_table q_lookup_route q_pk_report"
    " q_null_safe_join q_csv_roundtrip q_batches q_physical_lines table_launch table_satellite table_payload table_stage"
).split()


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["precision", "orders", "first_start", "last_start"] and df.count() > 0


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    result = db.execute(contract.oracle_sql()[name])
    assert canonical(df.columns, df.collect()) == canonical([d[0] for d in result.description], result.fetchall())
