"""All SQL twins at the smallest scale, and the shape of physical plans."""

import sys
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare
from keepwell.plans import queries as Q


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert compare(df.collect(), df.columns, result.fetchall(), names) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 150 and "rank" in df.columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries whose result is one row per table, or a small report.
@pytest.mark.parametrize("name", ["q_features", "q_ranked_list", "q_attach_segments", "q_dossier",
                                  "q_stratified_split", "q_rejected_records", "q_silhouette",
                                  "q_segment_overview", "t_order_ranking", "t_order_split"])
def test_no_cross_joins_no_python(spark, sf, name):
    text = plan(queries()[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["q_features", "q_stratified_split", "q_plain_split",
                                  "t_order_split", "t_order_sample", "q_fixed_sample"])
def test_whole_tables_never_meet_in_one_task(spark, sf, name):
    assert "SinglePartition" not in plan(queries()[name](spark, sf))


def test_split_is_a_projection(spark, sf):
    text = plan(queries()["t_order_split"](spark, sf))
    assert "Exchange" not in text and "Join" not in text


def test_scans_are_pruned_and_filtered(spark, sf):
    text = plan(Q.q_features(spark, sf))
    assert "EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in text
    text = plan(Q.q_status_counts(spark, sf))
    assert "lineitem" not in text and "events" not in text
