"""A representative subset of registered queries against their DuckDB SQL
at sf0.001 (the full set runs with tools/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from siftweb.session import TABLES
from tests.conftest import SF001
from tools.check_oracle import digest

SUBSET = ["p12_page_nodes", "p9_resolve_links", "l7_quote_links", "g6_weighted_edges",
          "r10_teleport_rank", "d1_merge_duplicates", "d6_guess_language", "q7_brackets",
          "q19_q20_snippets", "q21_q22_search", "q23_batch_search", "s7_upsert"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]
