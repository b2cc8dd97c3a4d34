"""Plan properties the design relies on, read from the physical plans."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from siftweb.operators import dedup as D
from siftweb.operators import nodes as N
from siftweb.operators import rank as R
from siftweb.operators import search as S
from siftweb.plans import catalog as C
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_scan_prunes_content(spark):
    p = plan(E.queries()["s4_scan_without_content"](spark, SF001))
    schema = [ln for ln in p.splitlines() if "ReadSchema" in ln or "FileScan" in ln]
    assert schema and not any("content:" in ln for ln in schema)


def test_graph_reads_two_columns_of_lineitem(spark):
    p = plan(E.queries()["g6_weighted_edges"](spark, SF001))
    reads = [ln for ln in p.splitlines() if "lineitem.parquet" in ln]
    assert reads and all("ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in ln for ln in reads)


def test_language_filter_reaches_the_scan(spark):
    p = plan(E.queries()["q1_language_filter"](spark, SF001))
    assert "PushedFilters: [IsNotNull(language)]" in p and "content" not in p


def test_search_is_top_k_with_snippets_after(spark):
    """Snippets are made above the cut, and a search does not read the links."""
    p = plan(E.queries()["q21_q22_search"](spark, SF001))
    assert p.count("TakeOrderedAndProject") == 1
    read = next(ln for ln in p.splitlines() if "ReadSchema" in ln)
    assert "out_links" not in read and "content_hash" not in read


def test_batch_search_partial_top_k(spark):
    p = plan(E.queries()["q23_batch_search"](spark, SF001))
    assert "WindowGroupLimit" in p


def test_store_deals_the_contents_once(spark, tmp_path):
    """Neither the merge nor the ranks shuffle the contents a second time."""
    C.page_nodes(spark, SF001).write.parquet(str(tmp_path / "pages"))
    parsed = spark.read.parquet(str(tmp_path / "pages"))
    ranks = parsed.select(F.col("url").alias("id"), F.lit(0.25).alias("rank")).limit(10)
    nodes, _ = D.merge_duplicates(parsed)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = C.ranked_nodes(nodes, ranks)
        steps = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*\bcontent#", steps)) == 1
        rows = {r.id: r for r in got.collect()}
        want = {r.id: r for r in R.apply_importance(nodes, ranks, "url").select(*N.NODE_COLUMNS).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == want and {r.importance for r in rows.values()} == {0.25, N.UNRANKED}


def test_postings_have_no_step_for_each_token(spark):
    """Sets of tokens are unfolded as they are: no lambda, no second weeding out of equal ones."""
    nodes = spark.createDataFrame([(1, ["b B é É", "a b"], "b"), (2, None, None), (3, ["x"], "X y X")], "id long, content array<string>, title string")
    got = S.postings(nodes)
    p = plan(got)
    assert "lambda" not in p and "array_distinct" not in p
    both, only = S.IN_FILTER | S.IN_CONTENT, S.IN_CONTENT
    assert sorted((r.token, r.bits) for r in got.filter("id = 1").collect()) == sorted(
        [("b", both), ("é", both), ("É<=_|_=>a", S.IN_FILTER), ("a", only), ("b", S.IN_FILTER | S.IN_TITLE)])
    assert sorted((r.token, r.bits) for r in got.filter("id = 3").collect()) == sorted(
        [("x", both), ("x", S.IN_FILTER | S.IN_TITLE), ("y", S.IN_FILTER | S.IN_TITLE)]) and got.filter("id = 2").isEmpty()
