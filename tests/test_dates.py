"""Versions and dates by cells, measures by catalogue, error reports of a source."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from quillbook.operators import controls, errors, lookups, scd2

DAY = date(2024, 1, 1)


@pytest.mark.parametrize("span", [0, 1, 7, 64, 400])
def test_in_force_equals_the_range_join(spark, span):
    rng = random.Random(span)
    rows = []
    for i in range(300):
        start = DAY + timedelta(rng.randint(-50, span + 50))
        stop = date(9999, 12, 31) if rng.random() < 0.3 else start + timedelta(rng.randint(-1, 120))
        rows.append((i, rng.choice("abc"), start, stop))
    rows.append((999, "a", None, None))
    days = sorted({(s, DAY + timedelta(rng.randint(0, span)), n) for s in "abx" for n in range(6)} | {("a", DAY, 9), ("a", DAY + timedelta(span), 9)})
    versions = spark.createDataFrame(rows, "id int, s string, start date, stop date")
    frame = spark.createDataFrame(days, "s string, day date, n int")
    found = lookups.in_force_on(versions, frame, ["s"], "start", "stop", "day")
    wanted = [(i, n, d) for i, s, a, b in rows for t, d, n in days if s == t and a is not None and a <= d <= b]
    assert values(found, "id", "n", "day") == sorted(wanted, key=lambda t: tuple(map(str, t)))
    assert sorted(found.columns) == ["day", "id", "n", "s", "start", "stop"]


def test_in_force_by_the_minute(spark):
    rows = [(1, "a", datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 23, 59)), (2, "a", datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 2, 0, 0)),
            (3, "a", datetime(2024, 1, 1, 8, 0), datetime(2024, 1, 1, 9, 0)), (4, "a", datetime(2023, 1, 1), datetime(9999, 12, 31))]
    versions = spark.createDataFrame(rows, "id int, s string, start timestamp, stop timestamp")
    days = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 1, 2))], "s string, day date")
    found = lookups.in_force_on(versions, days, ["s"], "start", "stop", "day")
    assert values(found, "id", F.dayofmonth("day")) == [(1, 1), (2, 2), (4, 1), (4, 2)]


def test_no_dates(spark):
    versions = spark.createDataFrame([(1, "a", DAY, DAY)], "id int, s string, start date, stop date")
    days = spark.createDataFrame([], "s string, day date")
    assert lookups.in_force_on(versions, days, ["s"], "start", "stop", "day").count() == 0


def test_only_some_relationships_count(spark):
    schema = "documentid int, batchid long, source_system_name string, pointofviewstartdate date, pointofviewstopdate date"
    contracts = spark.createDataFrame([(i, 1, "s", DAY, date(9999, 12, 31)) for i in (1, 2, 3)], schema)
    links = spark.createDataFrame(
        [(1, 10, 1, "s", "Primary Insured", DAY, date(9999, 12, 31)), (2, 10, 1, "s", "Owner", DAY, date(9999, 12, 31)), (3, 11, 5, "s", "Owner", DAY, DAY)],
        "contract_documentid int, party_documentid int, batchid long, source_system_name string, relationshiptype string, pointofviewstartdate date, pointofviewstopdate date")
    parties = spark.createDataFrame([(10, 5, "s")], "documentid int, batchid long, source_system_name string")
    now = spark.createDataFrame([(date(2024, 2, 1), 5, "s")], "cycle_date date, batch_id long, source_system_name string")
    assert values(scd2.touched_documents(now, contracts, links, parties), "documentid") == [(1,), (2,), (3,)]
    assert values(scd2.touched_documents(now, contracts, links, parties, kind="Primary Insured"), "documentid") == [(1,), (3,)]


def test_measures_of_several_systems_in_one_pass(spark):
    rows = spark.createDataFrame([
        ("d", "x", 1, 2.5, "u", DAY), ("d", "x", 1, None, "v", None), ("d", "y", 3, 1.0, "u", DAY), ("e", "x", 4, 1.0, None, DAY), ("f", "x", 9, 9.0, "w", DAY)],
        "domain_name string, source_system_name string, k int, amount double, kind string, day date")
    named = [("d", "x", "Total Count", "recordcount", "Y"), ("d", "x", "DistinctCount", "k", "Y"), ("d", "x", "Sum Total", "amount", "Y"),
             ("d", "x", "Sum Total on Year", "day", "Y"), ("d", "x", "Count grouped by distinct value", "kind", "Y"), ("d", "x", "Sum Total", "k", "N"),
             ("d", "y", "Sum Total", "amount", "Y"), ("d", "y", "Sum Total", "amount", "Y"), ("d", "y", "Sum Total", "no_such_field", "Y"),
             ("e", "x", "Count grouped by distinct value", "kind", "Y"), ("z", "x", "Total Count", "recordcount", "Y")]
    catalogue = spark.createDataFrame(named, "domain_name string, source_system_name string, measure_type string, measure_field string, is_active string")
    found = controls.measure_by_catalogue(rows, catalogue, ["k", "amount", "kind", "day"], "S", "hop")
    got = values(found, "control_id", "source_system_name", "operation", "group_col_val", F.col("fact_val").cast("double"))
    assert got == sorted([
        ("d_recordcount", "x", "Total Count", None, 2.0), ("d_k", "x", "DistinctCount", None, 1.0), ("d_amount", "x", "Sum Total", None, 2.5),
        ("d_day", "x", "Sum Total on Year", None, 2024.0), ("d_kind", "x", "Count grouped by distinct value", "u", 1.0),
        ("d_kind", "x", "Count grouped by distinct value", "v", 1.0), ("d_amount", "y", "Sum Total", None, 1.0),
        ("d_no_such_field", "y", "Sum Total", None, 0.0), ("e_kind", "x", "Count grouped by distinct value", None, 1.0)],
        key=lambda t: tuple((v is not None, str(v)) for v in t))
    plan = found._jdf.queryExecution().toString()
    assert plan.count("Scan ExistingRDD") <= 1 * plan.count("Physical Plan") + 3


def test_report_of_one_source(spark):
    rows = spark.createDataFrame([("t", DAY, 1, "Soft", "m", "Y")] * 3 + [("u", DAY, 1, "Soft", "m", "Y")],
                                 "table_name string, original_cycle_date date, original_batch_id int, error_classification_name string, error_message string, reprocess_flag string")
    named = spark.createDataFrame([(DAY, "a", "d", "DAILY"), (DAY, "a", "d", "DAILY"), (DAY, "b", "d", "DAILY"), (DAY, "a", "d", "MONTHLY")],
                                  "cycle_date date, source_system string, domain_name string, batch_frequency string")
    found = errors.error_details(rows, named, "a", "d", "DAILY", ["t"])
    assert values(found, "source_system", "error_record_count") == [("a", 3)]
    assert errors.error_details(rows, named, "a", "e", "DAILY").isEmpty()
