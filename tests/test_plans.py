"""Plans: what is read how often."""

import re

import pytest

from devpulse import adapters
from devpulse.operators.aggregates import grouped_distinct_counts
from devpulse.registry import QUERIES, marts
from devpulse.reporting import profiling

FOLDER = "/root/testdata/sf0.001"


def initial(df):
    """The plan before anything runs."""
    return df._jdf.queryExecution().sparkPlan().toString()


def scans(df, table):
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", initial(df)))


@pytest.mark.parametrize("name", ["technology_adoption", "said_vs_did", "dim_technologies"])
def test_lines_are_scanned_once(spark, monkeypatch, name):
    """The scan of the lines is where they are made short and written; three models read that."""
    written = []

    def note(df):
        written.append(df)
        return adapters_cut(df)

    adapters_cut = adapters.cut_lineage
    monkeypatch.setattr(adapters, "cut_lineage", note)
    df = QUERIES[name](spark, FOLDER)
    assert scans(df, "lineitem") == 0
    assert [scans(w, "lineitem") for w in written] == [1, 0]


def test_distinct_counts_read_their_input_once(spark):
    lines = adapters.load(spark, FOLDER, "lineitem")
    counted = {"a": "l_orderkey", "b": "l_suppkey", "c": "l_partkey", "d": "l_linestatus"}
    df = grouped_distinct_counts(lines, ["l_returnflag"], {"n": ("count", "*")}, counted)
    assert scans(df, "lineitem") == 1 and "Expand" not in initial(df)
    assert scans(profiling.range_and_cardinality(lines, "l_shipdate", ["l_orderkey", "l_partkey"]), "lineitem") == 1


def test_quantiles_rank_without_windows(spark):
    lines = adapters.load(spark, FOLDER, "lineitem")
    plan = initial(profiling.describe_numeric(lines, ["l_quantity", "l_extendedprice"]))
    assert "Window" not in plan and "lineitem" not in plan


@pytest.fixture
def few_orders(spark, tmp_path):
    """Forty orders of ten customers, two lines each."""
    orders = ["id AS o_orderkey", "id % 10 AS o_custkey", "timestamp '1995-02-03' AS o_orderdate"]
    orders += ["200000.0D + id AS o_totalprice", "'1-URGENT' AS o_orderpriority"]
    lines = ["id % 40 AS l_orderkey", "id % 5 AS l_partkey", "'A' AS l_returnflag", "id AS l_suppkey"]
    lines += ["1 AS l_linenumber", "'F' AS l_linestatus", "timestamp '1995-03-04' AS l_shipdate"]
    tables = {
        "orders": spark.range(40).selectExpr(*orders),
        "lineitem": spark.range(80).selectExpr(*lines),
        "part": spark.range(5).selectExpr("id AS p_partkey", "concat('Brand#', id + 1) AS p_brand"),
        "customer": spark.range(10).selectExpr("id AS c_custkey", "id AS c_nationkey", "'BUILDING' AS c_mktsegment"),
        "nation": spark.range(10).selectExpr("id AS n_nationkey", "'X' AS n_name"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["adoption_a", "adoption_b", "join_respondent"])
def test_partitions_of_respondents_grow_with_the_orders(spark, monkeypatch, few_orders, name):
    monkeypatch.setattr(adapters, "TASK_ORDERS", 2, raising=False)
    df = QUERIES[name](spark, few_orders)
    cut = re.findall(r"hashpartitioning\(response_id#\d+, survey_year#\d+, (\d+)\)", initial(df))
    assert cut and set(cut) == {"20"}
    assert df.count() == {"join_respondent": 10}.get(name, 5)


def test_buckets_grow_with_the_orders(spark, monkeypatch, few_orders):
    monkeypatch.setattr(adapters, "TASK_ORDERS", 2, raising=False)
    made = []

    def note(df, keys, buckets):
        made.append((df.rdd.getNumPartitions(), buckets))
        return df

    monkeypatch.setattr(marts, "scratch_table", note)
    assert sum(r.people for r in QUERIES["pay_join_bucketed"](spark, few_orders).collect()) == 10
    assert made == [(20, 20), (20, 20)]
