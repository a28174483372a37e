import shutil
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from conftest import values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_classify import both, known, raw, raw_row  # noqa: F401
from test_errors_and_tables import error, error_table, frame  # noqa: F401
from test_history import STEPS, WANTED, empty, load, staged, versions

from quillbook import session
from quillbook.operators import controls, errors, lookups, scd2
from quillbook.plans import load as loads
from quillbook.plans import warehouse
from quillbook.sources import journal, tables
from quillbook.sources.journal import APPEND, Journal


def files(path):
    """Data files with their times of change."""
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """Histories after one, two and three loads."""
    root = tmp_path_factory.mktemp("histories")
    history = warehouse.History.create(spark, str(root / "h"), staged(spark, STEPS[0]).schema)
    for number, rows in enumerate(STEPS, 1):
        history.load(staged(spark, rows), number)
        shutil.copytree(root / "h", root / str(number))
    return root


@pytest.fixture
def loaded(spark, prepared, tmp_path):
    """A copy of one of them below ``h``."""
    def copy(loads=3):
        shutil.copytree(prepared / str(loads), tmp_path / "h")
        return warehouse.History(spark, str(tmp_path / "h"))

    return copy


def test_loads_add_to_a_log(spark, loaded):
    history = loaded()
    at_once = staged(spark, sum(STEPS, []))
    assert versions(history.versions()) == versions(load(empty(at_once), at_once))
    assert values(history.in_force(), "k", "v") == [("a", "x"), ("b", "x"), ("c", "x"), ("d", "z")]
    assert values(history.commits(), "seq", "kind", "versions", "closures") == [
        (0, "create", 0, 0), (1, "load", 3, 0), (2, "load", 2, 1), (3, "load", 2, 2)]
    with pytest.raises(ValueError, match="already loaded"):
        history.load(staged(spark, STEPS[2]), 3)
    with pytest.raises(ValueError, match="later"):
        history.load(staged(spark, STEPS[0]), 0)
    before = versions(history.versions())
    assert history.load(empty(at_once), 9).isEmpty() and versions(history.versions()) == before


def test_a_load_rewrites_nothing(spark, loaded, tmp_path):
    history = loaded(2)
    before = files(tmp_path / "h")
    history.load(staged(spark, STEPS[2]), 3)
    gone = history.versions().where("k = 'b'").select(F.col(scd2.KEY).alias("documentid"), F.lit(date(2025, 1, 8)).alias("pointofviewstopdate"))
    history.delete(gone, 3)
    after = files(tmp_path / "h")
    assert before.items() <= after.items()
    assert ("b", "x", "2025-01-01", "2025-01-08") in versions(history.versions())
    assert values(history.closed_by([3]), F.col(scd2.START).cast("string")) == [("2025-01-01",), ("2025-01-05",), ("2025-01-05",)]


def test_a_load_reads_keys_and_dates_of_open_versions_only(loaded):
    history = loaded()
    rows = history.in_force(warehouse.NARROW)
    assert all("state=open" in f or "closures" in f for f in rows.inputFiles())
    plan = rows._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan"):]
    read = [p.split(">")[0] for p in physical.split("ReadSchema: struct<")[1:]]
    assert all(not {"k:string", "v:string"} & set(r.split(",")) for r in read)


def test_compaction_changes_files_only(spark, loaded, tmp_path):
    history = loaded()
    wanted, ended = versions(history.versions()), {f for f in files(tmp_path / "h") if "state=ended" in f}
    history.compact()
    assert versions(history.versions()) == wanted and ended <= set(files(tmp_path / "h"))
    assert len(history.vacuum()) == 3 and history.vacuum() == [] and versions(history.versions()) == wanted
    history.load(staged(spark, [("a", "q", 12, 4), ("e", "x", 12, 4)]), 4)
    assert ("a", "x", "2025-01-09", "2025-01-11") in versions(history.versions())
    history.compact()
    assert values(history.in_force(), "k", "v") == [("a", "q"), ("b", "x"), ("c", "x"), ("d", "z"), ("e", "x")]
    assert values(history.closed_by([3, 4]), scd2.BATCH) == [(3,), (3,), (4,)]


@pytest.mark.parametrize("part", [warehouse.ENDED, warehouse.CLOSURES, "commit"])
def test_a_load_that_dies_leaves_nothing(spark, loaded, monkeypatch, part):
    """Whatever was written last, readers see the load before, and the second run is whole."""
    history = loaded(2)
    before = versions(history.versions())
    write, commit = warehouse.History._write, warehouse.History._commit

    def dying(self, rows, to, seq):
        found = write(self, rows, to, seq)
        if to == part:
            raise RuntimeError("lost")
        return found

    def lost(self, *args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(warehouse.History, "_commit" if part == "commit" else "_write", lost if part == "commit" else dying)
        with pytest.raises(RuntimeError, match="lost"):
            history.load(staged(spark, STEPS[2]), 3)
    assert warehouse.History._commit is commit
    assert versions(history.versions()) == before
    history.load(staged(spark, STEPS[2]), 3)
    at_once = staged(spark, sum(STEPS, []))
    assert versions(history.versions()) == versions(load(empty(at_once), at_once))


def test_two_loads_at_a_time(spark, loaded, tmp_path):
    """Of two loads that take the same number the second finds its commit there."""
    history = loaded(1)
    other = warehouse.History(spark, str(tmp_path / "h"))
    log = other._log()
    history.load(staged(spark, STEPS[1]), 2)
    object.__setattr__(other, "_log", lambda: log)
    with pytest.raises(AnalysisException, match="already exists"):
        other.load(staged(spark, STEPS[2]), 3)


def test_intraday_history(spark, tmp_path):
    steps = scd2.Steps(intraday=True)
    first, second = ([("a", "x", 1, 1), ("a", "y", 1, 2)], [("a", "z", 1, 3), ("b", "x", 1, 3)])
    history = warehouse.History.create(spark, str(tmp_path / "h"), staged(spark, first, steps).schema, steps)
    one = empty(staged(spark, first, steps))
    for number, rows in enumerate((first, second), 1):
        history.load(staged(spark, rows, steps), number + 2)
        one = load(one, staged(spark, rows, steps), steps).checkpoint()
    assert versions(history.versions()) == versions(one)


def replay(spark, history, staging, number, days, group=None, unchanged=None):
    before = history.in_force()
    history.load(staging, number)
    named = spark.createDataFrame([(date(2025, 1, d), d) for d in days], "cycle_date date, batch_id int")
    rows = warehouse.replayed(staging, before, history, history.closed_by([number]), named, ["k", "v"], group, unchanged)
    measures = [controls.Measure(controls.TOTAL_COUNT), controls.Measure(controls.DISTINCT_COUNT, "k"),
                controls.Measure(controls.GROUPED_COUNT, "v"), controls.Measure(controls.SUM_YEAR, scd2.CYCLE)]
    return warehouse.balance_replay(rows, measures, "orders")


def test_replayed_load_balances(spark, loaded):
    history = loaded(1)
    feed = spark.createDataFrame([("c", "x", date(2025, 1, 5), 5, "UNCHANGED"), ("c", "x", date(2025, 1, 2), 2, "UNCHANGED")],
                                 "k string, v string, cycle_date date, batch_id int, cdc_action string")
    later = [(k, v, d, d) for k, v, d, _ in STEPS[1] + STEPS[2]]
    found = replay(spark, history, staged(spark, later), 9, [5, 9], unchanged=feed)
    count = found.where("operation = 'Total Count'")
    names = [scd2.BATCH, "s_value", "t_value", "sa_value", "ta_value", "si_value", "is_match"]
    assert [tuple(map(str, r)) for r in values(count, *[F.col(n).cast("double") if "value" in n else n for n in names])] == [
        ("5", "2.0", "2.0", "1.0", "1.0", "2.0", "Y"), ("9", "2.0", "2.0", "0.0", "0.0", "0.0", "Y")]
    assert found.where("is_match <> 'Y'").isEmpty()


def test_a_wrong_load_does_not_balance(spark, loaded):
    """A version left out, or an end that is missing, shows in the batch it belongs to."""
    history = loaded(1)
    staging = staged(spark, [(k, v, d, d) for k, v, d, _ in STEPS[1]])
    before = history.in_force()
    history.load(staging.where("k <> 'd'"), 9)
    named = spark.createDataFrame([(date(2025, 1, 5), 5)], "cycle_date date, batch_id int")
    count = [controls.Measure(controls.TOTAL_COUNT)]
    rows = warehouse.replayed(staging, before, history, history.closed_by([9]), named, ["k"])
    assert values(warehouse.balance_replay(rows, count, "x"), "s_value", "t_value", "is_match")[0][2] == "N"
    rows = warehouse.replayed(staging.where("k <> 'd'"), before, history, history.closed_by([9]).limit(0), named, ["k"])
    assert values(warehouse.balance_replay(rows, count, "x"), F.col("ended_variance").cast("int"), "is_match") == [(1, "N")]


def test_append_pattern(spark):
    spark.sql("drop table if exists appended")
    df = spark.createDataFrame([("a", date(2025, 1, 1), 1), ("b", date(2025, 1, 2), 2)], "v string, cycle_date date, batch_id int")
    staging = scd2.staging_append(df, df)
    tables.create(spark, "appended", staging.schema, ["batchid"])
    for _ in range(2):
        warehouse.append_rows(spark, "appended", staging)
    assert spark.table("appended").count() == 2


def test_a_second_run_starts_from_the_errors_before_the_first(spark, known, batch, error_table):
    h, _, _ = both(spark, known, batch, raw_row(), raw_row(source="999X"), raw_row(company="010"))
    tables.append(frame(spark, error(day=date(2025, 12, 1), number=5)), error_table)
    tables.append(h.hard.unionByName(h.cleared).unionByName(h.soft), error_table)
    with pytest.raises(ValueError, match="re-run not allowed"):
        loads.prepare_errors(spark, batch, error_table)
    loads.prepare_errors(spark, batch, error_table, rerun=True)
    assert values(spark.table(error_table), "original_batch_id", "reprocess_flag") == [(5, "Y")]


def test_cleared_errors_are_restored(spark, batch, error_table):
    record = {"a": "1", "cycle_date": "2025-12-05", "batch_id": 7, "old_error_message": "m"}
    tables.append(frame(spark, error(flag="R", kind="Cleared", message=None, record=record)), error_table)
    loads.prepare_errors(spark, batch, error_table, rerun=True)
    assert values(spark.table(error_table), "reprocess_flag", "error_message") == [("Y", "m")]


def test_ageing_in_the_table(spark, batch, error_table):
    tables.append(frame(spark, error(age=20), error(age=3)), error_table)
    loads.age_errors(spark, batch, error_table)
    assert values(spark.table(error_table), "reprocess_flag", "error_classification_name") == [("N", errors.AGED), ("Y", "Soft")]
    loads.age_errors(spark, replace(batch, batch_id=8), error_table, max_days=1)
    assert values(spark.table(error_table), "reprocess_flag") == [("N",), ("N",)]


def test_ageing_needs_the_other_side(spark, batch, error_table):
    """Headers alone are old: nothing moves. Once lines are old too, the headers move."""
    old = date(2025, 11, 1)
    tables.append(frame(spark, error(age=34, day=old), error(age=34, day=old, table="side_general_ledger_line_item")), error_table)
    with pytest.raises(ValueError, match="core 1 headers, 0 lines"):
        loads.age_errors(spark, batch, error_table, paired=True)
    assert values(spark.table(error_table), "reprocess_flag") == [("Y",), ("Y",)]
    tables.append(frame(spark, error(age=34, day=old, table="core_general_ledger_line_item")), error_table)
    loads.age_errors(spark, batch, error_table, paired=True)
    assert values(spark.table(error_table), "table_name", "reprocess_flag") == [
        ("core_general_ledger_header", "N"), ("core_general_ledger_line_item", "Y"), ("side_general_ledger_line_item", "Y")]


@pytest.mark.parametrize("dies", ["before the marker", "after the append", "between the partitions"])
def test_a_store_that_dies(spark, known, batch, error_table, monkeypatch, dies):
    """A second run ends with the same tables as one that never died."""
    h, _, _ = both(spark, known, batch, raw_row(), raw_row(source="999X"), raw_row(company="010"))
    spark.sql("drop table if exists stored")
    tables.create(spark, "stored", h.final.schema, ["cycle_date", "batch_id"])
    tables.append(frame(spark, error(flag="N", kind="Hard", day=date(2025, 12, 1), number=5)), error_table)
    replace_partition, calls = tables.replace_partition, []

    def dying(*args):
        calls.append(args)
        if len(calls) == (1 if dies == "after the append" else 2):
            raise RuntimeError("lost")
        replace_partition(*args)

    with monkeypatch.context() as m:
        if dies == "before the marker":
            m.setattr(Journal, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            m.setattr(tables, "replace_partition", dying)
        with pytest.raises(RuntimeError, match="lost"):
            loads.store(h, batch, "stored", error_table)
    loads.store(h, batch, "stored", error_table)
    columns = ["reprocess_flag", "original_batch_id", "error_message"]
    wanted = h.hard.unionByName(h.cleared).unionByName(h.soft).unionByName(
        frame(spark, error(flag="N", kind="Hard", day=date(2025, 12, 1), number=5)).select(*h.hard.columns), allowMissingColumns=True)
    assert values(spark.table(error_table), *columns) == values(wanted, *columns)
    assert spark.table("stored").count() == h.final.count() > 0
    assert not Journal(spark, "any").committed()


def test_part_of_an_append_is_completed(spark, error_table):
    """Files of an append that came through one by one: the partition is put together anew."""
    old, new = frame(spark, error(message="old")), frame(spark, error(message="a"), error(message="a"), error(message="b"))
    tables.append(old, error_table)
    entry = Journal(spark, "part")
    entry.put(new, error_table, APPEND)
    entry.commit()
    tables.append(new.where("error_message = 'b'"), error_table)
    entry.apply()
    assert values(spark.table(error_table), "error_message") == [("a",), ("a",), ("b",), ("old",)]
    assert entry.recover() is False


def test_stages_go_with_their_owner(spark, known, batch, error_table, tmp_path, monkeypatch):
    """A load within ``stages`` leaves its tables and nothing else in the shared folder."""
    for module in (session, journal):
        monkeypatch.setattr(module, "shared_folder", lambda _: str(tmp_path / "shared"))
    spark.sql("drop table if exists staged")
    with session.stages(spark):
        h, _, _ = both(spark, known, batch, raw_row(), raw_row(source="999X"))
        tables.create(spark, "staged", h.final.schema, ["cycle_date", "batch_id"])
        loads.store(h, batch, "staged", error_table)
        assert files(tmp_path / "shared")
    assert not files(tmp_path / "shared") and spark.table("staged").count() == 1
    with pytest.raises(RuntimeError), session.stages(spark):
        session.materialise(spark.range(3), "lost")
        raise RuntimeError
    loads.age_errors(spark, replace(batch, batch_id=8), error_table, max_days=-1)
    assert not files(tmp_path / "shared") and not session._scopes


@pytest.mark.parametrize("limit", ["1000000", "20"])
def test_as_of_equals_the_range_join(spark, limit):
    spark.conf.set("quillbook.group.rows", limit)
    try:
        versions_of = spark.range(60).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"),
                                             F.expr("date_add(date '2025-01-01', cast(id * 3 as int))").alias("start"),
                                             F.expr("date_add(date '2025-01-01', cast(id * 3 + 3 as int))").alias("stop"))
        rows = spark.range(200).select("id", (F.col("id") % 3).alias("k"), F.expr("date_add(date '2024-12-30', cast(id as int))").alias("d"))
        found = lookups.as_of(rows, versions_of, ["k"], "d", "start", "stop").select("id", "v")
        joined = rows.join(versions_of, (rows["k"] == versions_of["k"]) & rows["d"].between(versions_of["start"], versions_of["stop"]), "left")
        assert values(found) == values(joined.select("id", "v"))
    finally:
        spark.conf.unset("quillbook.group.rows")
