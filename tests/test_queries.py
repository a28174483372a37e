"""Every query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest
from check import TABLES, rows
from conftest import FOLDER, values

import __spark_entry__ as contract
from oracle.sql import ORACLE
from quillbook.plans import load, queries, workload
from quillbook.plans.queries import QUERIES
from quillbook.sources import extracts as ex



@pytest.fixture(scope="module", autouse=True)
def inputs():
    """The queries of this module share their inputs."""
    with workload.inputs():
        yield


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLE:
        assert len(found) > 0
        return
    assert rows(found) == rows(database.execute(ORACLE[name]).df())


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_shuffled_once(spark):
    """Headers too large to broadcast: the number's window needs no shuffle beyond the join's."""
    raw, known = workload.extracts(spark, FOLDER), load.Lookups(**workload.lookups(spark, FOLDER))
    headers = workload.loaded_headers(spark, FOLDER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plan = plan_of(load.classified_lines(raw, known, headers, workload.LINE_BATCH))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [_header_key" in plan and "Window [row_number()" in plan
    assert plan.count("Exchange hashpartitioning(_header_key") == 2


def test_newest_rows_are_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["lookup_latest"](spark, FOLDER))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_existing_tables_only(spark):
    spark.sql("drop table if exists here")
    spark.range(1).write.saveAsTable("here")
    assert list(ex.existing_tables(spark, ["here", "nowhere"])) == ["here"]


def test_line_loads_read_each_extract_once_and_prune(spark):
    """The plan of the line load filters on the partition column and reads its own columns only."""
    plan = plan_of(ex.header_rows(workload.extracts(spark, FOLDER), 20251205))
    assert "PartitionFilters: [isnotnull(cycle_date" in plan
    assert "fsi_gl_pt_description_1" not in plan


def rows_of_joins(df):
    """Rows that each join of a plan has made, once it ran."""
    df.collect()
    todo, made = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.finalPhysicalPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        if "Join" in name:
            made.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return made


def test_parties_do_not_meet_every_order(spark, tmp_path):
    """Ten times the orders of both signs and without a customer: the same parties, and no more rows on the way."""
    orders = workload.table(spark, FOLDER, "orders")
    copies = orders.crossJoin(spark.range(10)).drop("id")
    signed = copies.unionByName(copies.withColumn("o_custkey", -copies["o_custkey"]))
    signed.unionByName(orders.selectExpr("o_orderkey", "null as o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
                       ).write.parquet(str(tmp_path / "orders.parquet"))
    workload.table(spark, FOLDER, "supplier").write.parquet(str(tmp_path / "supplier.parquet"))
    found = queries._system_parties(spark, str(tmp_path))
    assert values(found) == values(workload.query(spark, str(tmp_path), queries.SYSTEM_PARTIES))
    assert rows_of_joins(found) == [found.count()]
