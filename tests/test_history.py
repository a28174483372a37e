from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from quillbook.functions import groups
from quillbook.operators import batches, cdc, scd2
from quillbook.operators.batch import Batch

SCHEMA = "k string, v string, cycle_date date, batch_id int"


def staged(spark, rows, steps=scd2.Steps()):
    df = spark.createDataFrame([(k, v, date(2025, 1, d), b) for k, v, d, b in rows], SCHEMA)
    return scd2.staging_type2(df, df.select("cycle_date", "batch_id"), ["k"], ["v"], steps)


def empty(staging):
    return staging.where(F.lit(False))


def versions(history):
    return values(history, "k", "v", F.col(scd2.START).cast("string"), F.col(scd2.STOP).cast("string"))


def load(history, staging, steps=scd2.Steps()):
    return scd2.apply_working(history, scd2.working_type2(staging, history, steps), steps)


STEPS = [
    [("a", "x", 1, 1), ("b", "x", 1, 1), ("c", "x", 1, 1)],
    [("a", "y", 5, 2), ("b", "x", 5, 2), ("d", None, 5, 2)],
    [("a", "x", 9, 3), ("d", "z", 9, 3)],
]
WANTED = [
    ("a", "x", "2025-01-01", "2025-01-04"), ("a", "x", "2025-01-09", "9999-12-31"), ("a", "y", "2025-01-05", "2025-01-08"),
    ("b", "x", "2025-01-01", "9999-12-31"), ("c", "x", "2025-01-01", "9999-12-31"),
    ("d", None, "2025-01-05", "2025-01-08"), ("d", "z", "2025-01-09", "9999-12-31"),
]


def test_batches_one_by_one_and_all_at_once(spark):
    at_once = staged(spark, sum(STEPS, []))
    assert versions(load(empty(at_once), at_once)) == sorted(WANTED, key=lambda t: tuple((v is not None, str(v)) for v in t))
    history = empty(at_once)
    for rows in STEPS:
        history = load(history, staged(spark, rows)).checkpoint()
    assert versions(history) == versions(load(empty(at_once), at_once))


def test_large_keys_give_the_same_history(spark):
    rows = [("hot", str(i * i % 5), 1 + i % 28, 1 + i % 28) for i in range(28)] + STEPS[0]
    staging = staged(spark, rows)
    wanted = versions(load(empty(staging), staging))
    spark.conf.set(groups.GROUP_ROWS, "10")
    try:
        assert versions(load(empty(staging), staging)) == wanted
    finally:
        spark.conf.unset(groups.GROUP_ROWS)


def test_actions(spark):
    first = staged(spark, STEPS[0])
    history = load(empty(first), first)
    working = scd2.working_type2(staged(spark, STEPS[1]), history)
    assert values(working, "k", scd2.ACTION, scd2.SOURCE) == [
        ("a", "INSERT", "Staging"), ("a", "UPDATE", "Target"), ("b", "UNCHANGED", "Staging"),
        ("b", "UNCHANGED", "Target"), ("d", "INSERT", "Staging")]
    assert scd2.load_state(history, working) == "new"
    after = scd2.apply_working(history, working)
    assert scd2.load_state(after, working) == "loaded"
    assert scd2.load_state(after.where("k <> 'd'"), working) == "partial"
    with pytest.raises(ValueError):
        scd2.require_newest(after, F.lit(date(2025, 1, 1)), F.lit(1))
    scd2.require_newest(after, F.lit(date(2025, 1, 5)), F.lit(2))


def test_intraday_slots(spark):
    steps = scd2.Steps(intraday=True)
    staging = staged(spark, [("a", "x", 1, 1), ("a", "y", 1, 2), ("a", "z", 1, 3), ("b", "x", 1, 1)], steps)
    found = load(empty(staging), staging, steps)
    assert versions(found) == [
        ("a", "x", "2025-01-01 00:00:00", "2025-01-01 00:29:00"),
        ("a", "y", "2025-01-01 00:30:00", "2025-01-01 00:59:00"),
        ("a", "z", "2025-01-01 01:00:00", "9999-12-31 00:00:00"),
        ("b", "x", "2025-01-01 00:00:00", "9999-12-31 00:00:00")]
    # The day goes on in another load: slots count on from the open version.
    later = load(found, staged(spark, [("a", "w", 1, 4), ("a", "v", 1, 5)], steps), steps)
    assert [v for v in versions(later) if v[1] in "wvz" and v[0] == "a"] == [
        ("a", "v", "2025-01-01 02:00:00", "9999-12-31 00:00:00"),
        ("a", "w", "2025-01-01 01:30:00", "2025-01-01 01:59:00"),
        ("a", "z", "2025-01-01 01:00:00", "2025-01-01 01:29:00")]


def test_deleted_documents_are_closed(spark):
    first = staged(spark, STEPS[0])
    history = load(empty(first), first)
    gone = history.where("k = 'a'").select(F.col(scd2.KEY).alias("documentid"), F.lit(date(2025, 1, 3)).alias("pointofviewstopdate"))
    assert ("a", "x", "2025-01-01", "2025-01-03") in versions(scd2.close_deleted(history, gone))


def test_append_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "batchid int, v string")
    working = scd2.working_append(df.where("batchid = 2"))
    named = spark.createDataFrame([(2,)], "batchid int")
    once = scd2.append_to_history(df.where("batchid = 1"), working, named, ["batchid"])
    assert values(scd2.append_to_history(once, working, named, ["batchid"])) == values(once) == [(1, "a"), (2, "b")]


def test_change_detection(spark, batch):
    loaded = spark.createDataFrame([
        ("a", "old", date(2025, 1, 1), 5), ("a", "x", date(2025, 1, 2), 6), ("b", "x", date(2025, 1, 1), 5),
        (None, "x", date(2025, 1, 1), 5), ("c", "later", date(2025, 1, 1), 9)], "k string, v string, cycle_date date, batch_id int")
    new = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "x"), ("c", "later"), ("d", None)], "k string, v string")
    found = cdc.change_actions(new, loaded, ["k"], ["v"], batch)
    assert values(found, "k", "cdc_action") == [
        (None, "UNCHANGED"), ("a", "UNCHANGED"), ("b", "INSERT"), ("c", "INSERT"), ("d", "INSERT")]


def test_deletes(spark, batch):
    loaded = spark.createDataFrame([("a", batch.cycle_date, 7), ("b", batch.cycle_date, 7), ("z", batch.cycle_date, 6)],
                                   "documentid string, cycle_date date, batch_id int")
    final = spark.createDataFrame([("a",)], "documentid string")
    assert values(cdc.missing_keys(loaded, final, batch), "documentid", "pointofviewstopdate") == [("b", date(2025, 12, 4))]
    rows = spark.createDataFrame([("a", "DELT"), ("b", None), ("c", "UPDT")], "documentid string, operationcode string")
    assert values(cdc.coded_deletes(rows, batch), "documentid") == [("a",)]
    assert values(cdc.without_deletes(rows)) == [("b",), ("c",)]


def test_expired_contracts(spark, batch):
    expired = spark.createDataFrame([(1, "P1"), (2, "P2")], "policy_id int, policy_no string")
    seen = spark.createDataFrame([(1, "P1", batch.domain, batch.source_system, date(2025, 1, 1)),
                                  (2, "P2", batch.domain, batch.source_system, batch.cycle_date)],
                                 "policy_id int, policy_no string, domain_name string, source_system string, cycle_date date")
    assert values(cdc.newly_expired(expired, seen, batch), "policy_no") == [("P2",)]
    rows = spark.createDataFrame([("P1",), ("P9",)], "contractnumber string")
    assert values(cdc.without_expired(rows, expired)) == [("P9",)]


def test_overlap_and_guards(spark):
    history = spark.createDataFrame([("s", date(2025, 1, 1), 1), ("s", date(2025, 1, 9), 5)], "source_system_name string, cycledate date, batchid int")
    current = spark.createDataFrame([("s", date(2025, 1, 9), 9), ("s", date(2025, 2, 1), 9)], "source_system_name string, cycle_date date, batch_id int")
    assert values(batches.overlapping(current, history), "cycle_date") == [(date(2025, 1, 9),)]
    assert batches.overlapping(current, history, both=True).isEmpty()
    with pytest.raises(ValueError):
        batches.require_none(batches.overlapping(current, history), "already processed")


def test_run_guard(spark):
    table = spark.createDataFrame([(date(2025, 1, 2), 2, date(2025, 1, 1), 1)], "cycle_date date, batch_id int, original_cycle_date date, original_batch_id int")
    none = spark.createDataFrame([], "table_name string, reprocess_flag string, original_cycle_date date, original_batch_id int")

    def state(day, number):
        return batches.rerun_state(table, none, F.lit(date(2025, 1, day)), F.lit(number), "t")

    batches.require_run_allowed(state(3, 3), rerun=False)
    for day in (1, 2):
        with pytest.raises(ValueError):
            batches.require_run_allowed(state(day, day), rerun=False)
        batches.require_run_allowed(state(day, day), rerun=True)


def test_completeness_of_current_batches(spark):
    row = ("d", "s", "DAILY")
    current = spark.createDataFrame([(*row, 1, date(2025, 1, 1)), (*row, 2, date(2025, 1, 1)), (*row, 3, date(2025, 1, 2))],
                                    "domain_name string, source_system string, batch_frequency string, batch_id int, cycle_date date")
    assert values(batches.duplicate_runs(current), "cycle_date", "runs") == [(date(2025, 1, 1), 2)]
    done = current.where("batch_id < 3")
    assert values(batches.unfinished(current, done), "batch_id") == [(3,)]
    assert values(batches.already_completed(current, done), "batch_id") == [(1,), (2,)]
    assert values(batches.newly_completed(current, done, F.lit(datetime(2025, 1, 3))), "batch_id") == [(3,)]
    assert values(batches.next_batch(current, done), "batch_id", "cycle_date") == [(3, date(2025, 1, 2))]


def test_batch_identity():
    b = Batch("core", "general_ledger_header", date(2025, 12, 5), 7, datetime(2025, 12, 8))
    assert (b.table_name, b.cycle_number) == ("core_general_ledger_header", 20251205)


def test_one_per_document_with_nulls_and_ties(spark):
    rows = spark.createDataFrame(
        [("a", 2, "x"), ("a", None, "y"), ("b", 1, "z"), ("b", 1, "w"), (None, 5, "u"), (None, 4, "v")], "d string, n int, v string")
    found = cdc.one_per_document(rows, ["d"], ["n", "v"])
    assert {tuple(r) for r in found.collect()} == {("a", None, "y"), ("b", 1, "w"), (None, 4, "v")} and found.count() == 3
    assert cdc.one_per_document(rows.limit(0), ["d"], ["n"]).isEmpty()
