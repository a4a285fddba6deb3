"""Every registered query against its SQL, and the plans of those whose shape matters."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registered  # noqa: E402
from compare import connect, difference  # noqa: E402
from wattlake.operators import chunks, cleaning, retrieval  # noqa: E402
from wattlake.sources import tables  # noqa: E402

QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert difference(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedup_latest_mix"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2


def test_daily_products_read_only_their_columns(spark, sf_dir):
    text = plan(QUERIES["daily_relative_mix"](spark, sf_dir))
    assert "props" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["flatten_mix_json", "unpivot_flows_json", "chunk_fixed", "chunk_tokens", "clean_text"])
def test_no_python_in_the_hot_path(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text


def test_text_is_not_shuffled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lines = cleaning.boilerplate_lines(docs, 2)
    for df in (chunks.chunk_fixed(docs), chunks.chunk_tokens(docs), chunks.chunk_recursive(docs),
               retrieval.embed(docs), cleaning.clean_text(docs, lines)):
        assert "Exchange" not in plan(df)


def test_only_small_scans_are_spread(spark, sf_dir):
    one = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "RoundRobin" in plan(tables.spread(one))
    many = spark.range(0, 1000, 1, 8)
    assert tables.spread(many) is many


def test_hits_are_broadcast_to_their_items(spark, sf_dir):
    text = plan(QUERIES["rerank_top3"](spark, sf_dir))
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_tables(spark, sf_dir, name):
    if name.startswith(("medallion", "sql_latest", "sql_insp", "stream")):
        pytest.skip("reads a table written before")
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
