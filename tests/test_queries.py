"""Every registered query against its SQL, and the plans they run as."""

import glob

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from terrametry.plans.queries import load
from terrametry.session import scratch_path
from tools.check import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = load()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert slow not in plan
    names, rows = spark_rows(df)
    assert rows
    if name in SQL:
        want_names, want = sql_rows(tables, SQL[name])
        assert names == want_names and rows == want


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark):
    plan = plan_of(QUERIES["outlier_filter"](spark, SF_DIR))
    assert "GreaterThan(l_extendedprice,1000.0)" in plan
    assert "l_orderkey" not in plan
    assert "In(l_returnflag, [A,R])" in plan_of(QUERIES["territory_overview"](spark, SF_DIR))


def test_partition_filter_reaches_the_table(spark):
    from terrametry.operators.reports import department_stats
    from terrametry.plans.queries.storage import SALE_TABLE, _written_sales
    from terrametry.sources import read_parquet

    path, _ = _written_sales(spark, SF_DIR)
    plan = plan_of(department_stats(read_parquet(spark, path, SALE_TABLE), "05"))
    assert "PartitionFilters: [isnotnull(code_departement" in plan
    assert "valeur_fonciere:double,prix_m2:double" in plan and "id_disposition" not in plan


def test_distinct_counts_do_not_expand_the_scan(spark):
    plan = plan_of(QUERIES["active_profile"](spark, SF_DIR))
    assert "Expand" not in plan


def test_held_runs_share_one_scan_and_shuffle(spark):
    df = QUERIES["alert_hold"](spark, SF_DIR)
    df.collect()
    plan = plan_of(df).split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_bucketed_tables_join_without_a_shuffle(spark):
    plan = plan_of(QUERIES["left_enrich_bucketed"](spark, SF_DIR))
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan


def test_frequent_and_missing_keys_are_spread(spark):
    """A third of the rows share one key: shuffled by key and salt, no task has them all."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["left_enrich_skewed"](spark, SF_DIR)
        plan = plan_of(df)
        assert "SortMergeJoin" in plan and "hashpartitioning(order_key" in plan and "_salt" in plan
        parts = df.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    salt = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(16))
    hot = df.filter("order_key = 1 OR order_key IS NULL").groupBy("order_key", salt.alias("salt")).count().collect()
    assert len(hot) == 32 and max(r["count"] for r in hot) < df.count() / 20 and parts


def test_rules_make_no_row_for_each_step(spark):
    plan = plan_of(QUERIES["evaluate_rules"](spark, SF_DIR))
    assert "events.parquet" not in plan and "sequence(" not in plan.replace("sequence(greatest", "")


def many_files(spark, tmp_path, *names):
    """Tables of sf0.001 in five files each, which eight cores read by five tasks."""
    for name in names:
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(5).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name, part, tables", [
    ("csv_multiline", "texts-", ("documents",)),
    ("warehouse_job", "raw-", ("customer", "orders", "lineitem", "documents")),
])
def test_text_is_written_by_the_tasks_that_read_the_input(spark, tmp_path, name, part, tables):
    source = many_files(spark, tmp_path / "in", *tables)
    folder = f"{scratch_path(spark, 'x').rsplit('/', 1)[0]}/{part}*"
    old = set(glob.glob(folder))
    rows = QUERIES[name](spark, source).count()
    new, = set(glob.glob(folder)) - old
    assert rows == QUERIES[name](spark, SF_DIR).count()
    assert len(glob.glob(f"{new}/part-*" if name == "csv_multiline" else f"{new}/firms/part-*")) == 5
