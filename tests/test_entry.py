"""A cross-section of the registered queries beside their SQL; tools/check_oracles.py
runs all of them."""

import duckdb
import pytest

import __spark_entry__ as entry
from kindred.plans import registry
from tools.check_oracles import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert registry.QUERIES.keys() == registry.ORACLES.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", [
    "topn_padded", "cosine_pairs", "explode_positions", "idf", "page_cards", "page_first_link",
    "surrogate_key", "sink_serving", "nest_by_name", "view_browse", "view_stats", "stream_arrival"])
def test_agrees_with_sql(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    done = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in done.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, done.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "match_id", "similarity", "rank"]
