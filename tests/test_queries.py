"""Every registered query against its SQL, and the shape of its plan."""

import contextlib
import io
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry_point  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def connection():
    duckdb = pytest.importorskip("duckdb")
    import check_oracles

    con = duckdb.connect()
    for t in check_oracles.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry_point.queries() if n.startswith("q_")))
def test_query(spark, connection, name):
    from check_oracles import canonical

    df = entry_point.queries()[name](spark, DATA)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    result = connection.execute(entry_point.oracle_sql()[name])
    want = canonical([d[0] for d in result.description], result.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0


def test_filters_and_columns_reach_the_files(spark):
    plan = plan_of(entry_point.queries()["q_obs_filter"](spark, DATA), "formatted")
    assert "EqualTo(l_linestatus,O)" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "l_tax" not in plan.split("ReadSchema")[1]


def test_alignment_shuffles_no_facts(spark):
    from macroloom.plans.align import align_observations
    from macroloom.showcase.alignment import area_map, codelists

    table = lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")
    feed = table("lineitem").selectExpr(
        "string(l_suppkey) COUNTRY", "string(l_partkey) INDICATOR", "l_returnflag UNIT", "l_linestatus FREQUENCY",
        "string(l_linenumber) SCALE", "string(year(l_shipdate)) TIME_PERIOD", "string(l_extendedprice) OBS_VALUE",
    )
    plan = plan_of(align_observations(feed, codelists(table), area_map(table)))
    assert plan.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in plan
    facts_part = plan.split("l_extendedprice")[0]
    assert "Exchange hashpartitioning" not in facts_part


def test_large_dimensions_are_not_broadcast(spark):
    from macroloom.operators.lookup import lookup

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        df, dim = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("lineitem", "orders"))
        plan = plan_of(lookup(df, dim, {"l_orderkey": "o_orderkey"}, {"o_orderstatus": "status"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_first_k_is_cut_down_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from macroloom.operators.releases import keep_first_k

    df = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_suppkey", "l_orderkey", "l_linenumber")
    plan = plan_of(keep_first_k(df, ["l_suppkey"], [F.col("l_orderkey").desc(), F.col("l_linenumber")], 2))
    assert plan.count("WindowGroupLimit") == 2


def test_documents_are_parsed_once(spark):
    for name, call in (("q_xml_roundtrip", "from_xml("), ("q_codelist_json", "from_json(")):
        assert plan_of(entry_point.queries()[name](spark, DATA)).count(call) == 1


def test_ordinal_never_sorts_a_whole_group(spark):
    plan = plan_of(entry_point.queries()["q_ordinal"](spark, DATA))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("row_number" not in w or "__at" in w for w in windows)
