import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from quillbook.operators import controls, errors, hierarchy, lookups, reshape
from quillbook.sources import jdbc, tables

TS = datetime(2025, 12, 1)


def error(flag="Y", kind="Soft", day=date(2025, 12, 1), number=5, age=4, record=None, message="m", table="core_general_ledger_header"):
    return (TS, TS, day, number, kind, message, age, json.dumps(record or {"a": "1"}), table, flag)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), errors.ERROR_SCHEMA)


SCHEMA = "STRUCT<a: STRING, b: STRING, cycle_date: STRING, batch_id: BIGINT, old_error_message: STRING>"


def test_scenarios(spark, batch):
    rows = frame(spark, error(), error(flag="N", kind="Hard", day=batch.cycle_date, number=7),
                 error(day=batch.cycle_date, number=7), error(table="other"), error(flag="R", kind="Cleared"))
    assert errors.reprocessable(rows, batch).count() == 1
    assert errors.of_batch(rows, batch).count() == 2
    assert errors.forced(rows, batch).count() == 1


def test_explode_fills_missing_fields(spark):
    rows = errors.explode_errors(frame(spark, error(record={"a": "1"}), error(record={"b": "2"})), ["a", "b", "c"])
    assert values(rows, "a", "b", "c") == [(None, "2", None), ("1", None, None)]


def test_schema_is_inferred_over_all_records(spark):
    rows = frame(spark, error(record={"a": "1", "n": None}), error(record={"b": {"x": 1}}))
    parsed = rows.select(F.from_json("error_record", errors.error_schema(rows)).alias("r"))
    assert values(parsed, "r.a", "r.b.x", "r.n") == [(None, 1, None), ("1", None, None)]


@pytest.mark.parametrize("age, kind", [(13, "Soft"), (14, "Soft"), (15, errors.AGED)])
def test_ageing_and_back(spark, batch, age, kind):
    rows = frame(spark, error(age=age))
    aged = errors.age_soft_errors(rows, batch, SCHEMA)
    assert values(aged, "error_classification_name") == [(kind,)]
    if kind == errors.AGED:
        assert json.loads(aged.first()["error_record"]) == {"a": "1", "cycle_date": "2025-12-05", "batch_id": 7}
        back = errors.reinstate_errors(aged, batch, errors.HARD, SCHEMA, rerun=True)
        assert values(back, "error_classification_name", "reprocess_flag", "error_record") == [("Soft", "Y", '{"a":"1"}')]


def test_aged_pairs(spark):
    old, young = frame(spark, error(age=20)), frame(spark, error(age=2))
    errors.check_aged_pair(old, old)
    with pytest.raises(ValueError):
        errors.check_aged_pair(old, young)


def test_aged_pairs_by_source_system(spark, batch):
    day = date(2025, 11, 1)
    rows = frame(
        spark, error(day=day), error(day=day, table="core_general_ledger_line_item"), error(day=day, table="side_general_ledger_header"),
        error(table="side_general_ledger_line_item"), error(day=day, flag="N", table="late_general_ledger_line_item"))
    found = errors.aged_pairs(rows, batch.cycle())
    assert values(found, "source_system_name", "aged_headers", "aged_lines", "consistent") == [
        ("core", 1, 1, True), ("late", 0, 0, True), ("side", 1, 0, False)]
    errors.require_aged_pairs(rows.where("table_name not like 'side%'"), batch.cycle())
    errors.require_aged_pairs(rows.limit(0), batch.cycle())
    with pytest.raises(ValueError, match="side 1 headers, 0 lines"):
        errors.require_aged_pairs(rows, batch.cycle())


def test_error_view_reads_records_of_any_fields(spark):
    """Records without a common schema, a field name with a digit in front, a number, and a text that is no JSON."""
    rows = frame(spark, error(record={"a": "1", "1035x": "y"}), error(record={"a": {"b": 2}}), error(record={"n": 3}))
    broken = rows.limit(1).withColumn("error_record", F.lit("no json"))
    view = errors.error_view(rows.unionByName(broken), "%header%", ["a", "1035x", "n"])
    assert "from_json" not in view._jdf.queryExecution().optimizedPlan().toString()
    assert values(view, "a", "1035x", "n") == [
        (None, None, None), (None, None, "3"), ("1", "y", None), ('{"b":2}', None, None)]
    assert dict(view.dtypes)["error_record"] == "variant"


def test_reinstating_after_a_run_gives_the_rows_before_it(spark, batch):
    cleared = error(flag="R", kind="Cleared", message=None, age=0, record={
        "a": "1", "cycle_date": "2025-12-05", "batch_id": 7, "old_error_message": "m"})
    older = error(flag="R", kind="Cleared", record={"a": "9", "cycle_date": "2025-12-04", "batch_id": 6, "old_error_message": "m"})
    found = errors.reinstate_processed(frame(spark, cleared, older, error(record={"a": "2"})), batch, SCHEMA)
    assert values(found, "reprocess_flag", "error_message", "error_classification_name", F.get_json_object("error_record", "$.a")) == [
        ("R", "m", "Cleared", "9"), ("Y", "m", "Soft", "2"), ("Y", "m", errors.RERUN, "1")]
    back = found.where(F.col("error_classification_name") == errors.RERUN).first()
    assert json.loads(back["error_record"]) == {"a": "1"} and back["error_record_aging_days"] == 4


def test_rerun_is_refused_beside_older_errors(spark, batch):
    own = error(flag="N", kind="Hard", day=batch.cycle_date, number=7)
    rows = frame(spark, own, error(flag="N", kind="Hard"))
    with pytest.raises(ValueError):
        errors.reinstate_errors(rows, batch, errors.HARD, SCHEMA, rerun=False)
    assert errors.reinstate_errors(rows, batch, errors.HARD, SCHEMA, rerun=True).count() == 1
    assert errors.reinstate_errors(frame(spark, own), batch, errors.HARD, SCHEMA, rerun=False).isEmpty()


def test_rerun_markers(spark):
    rows = frame(spark, error(kind=errors.RERUN), error())
    assert values(errors.repair_rerun_markers(rows, rerun=False), "error_classification_name", "reprocess_flag") == [
        ("Cleared", "R"), ("Soft", "Y")]
    with pytest.raises(ValueError):
        errors.repair_rerun_markers(rows, rerun=True)


def test_field_edits(spark):
    rows = frame(spark, error(record={"a": "1", "b": "2"}))
    record = lambda df: json.loads(df.first()["error_record"])
    assert record(errors.add_field(rows, "c", F.lit("3"), SCHEMA)) == {"a": "1", "b": "2", "c": "3"}
    assert record(errors.add_field(rows, "a", F.lit("9"), SCHEMA, overwrite=False))["a"] == "1"
    assert record(errors.rename_fields(rows, {"a": "z", "q": "r"}, SCHEMA)) == {"b": "2", "z": "1"}
    with pytest.raises(ValueError):
        errors.rename_fields(rows, {"q": "r"}, SCHEMA, skip_missing=False)
    assert record(errors.update_field(rows, "b", "concat(parsed_json.a, parsed_json.b)", SCHEMA))["b"] == "12"
    assert record(errors.update_field(rows, "new", "parsed_json.a", SCHEMA)) == {"a": "1", "b": "2"}
    assert record(errors.update_field(rows, "new", "parsed_json.a", SCHEMA, add_missing=True))["new"] == "1"


@pytest.fixture
def error_table(spark):
    spark.sql("drop table if exists curated_error")
    tables.create(spark, "curated_error", frame(spark).schema, ["table_name", "reprocess_flag"])
    return "curated_error"


def test_empty_soft_set_clears_its_partition(spark, batch, error_table):
    tables.append(frame(spark, error(), error(flag="N", kind="Hard"), error(table="other")), error_table)
    spot = {"table_name": batch.table_name, "reprocess_flag": "Y"}
    tables.overwrite_partitions(frame(spark), error_table)
    assert spark.table(error_table).count() == 3
    tables.replace_partition(frame(spark), error_table, spot)
    assert values(spark.table(error_table), "table_name", "reprocess_flag") == [(batch.table_name, "N"), ("other", "Y")]
    tables.replace_partition(frame(spark, error(record={"a": "7"})), error_table, spot)
    tables.replace_partition(frame(spark, error(record={"a": "8"})), error_table, spot)
    assert spark.table(error_table).where(tables.matches(spot)).count() == 1
    tables.truncate_and_load(frame(spark, error()), error_table)
    assert spark.table(error_table).count() == 1


def test_clearing_an_external_partition(spark, batch, tmp_path):
    spark.sql("drop table if exists outside")
    tables.create(spark, "outside", frame(spark).schema, ["table_name", "reprocess_flag"], str(tmp_path / "t"))
    tables.append(frame(spark, error(), error(flag="N")), "outside")
    tables.clear_partition(spark, "outside", {"table_name": batch.table_name, "reprocess_flag": "Y"})
    assert values(spark.table("outside"), "reprocess_flag") == [("N",)]
    assert values(spark.read.parquet(str(tmp_path / "t")), "reprocess_flag") == [("N",)]


def test_missing_columns_are_filled(spark):
    df = spark.createDataFrame([(1,)], "b int")
    target = spark.createDataFrame([], "a string, b bigint").schema
    found = tables.in_table_order(df, target)
    assert found.schema.simpleString() == "struct<a:string,b:bigint>" and values(found) == [(None, 1)]


def test_back_up(spark, batch, tmp_path):
    rows = frame(spark, error(), error(flag="N"), error(table="other"))
    full = tables.backup_rows(rows, batch.table_name, "full_backup")
    tables.back_up(full, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2
    assert tables.backup_rows(rows, batch.table_name, "rerun", "N").count() == 1
    with pytest.raises(ValueError):
        tables.backup_rows(rows, batch.table_name, "rerun")


def test_views_have_their_columns(spark):
    assert (len(tables.HEADER_VIEW), len(set(tables.LINE_VIEW))) == (21, len(tables.LINE_VIEW))
    view = tables.projection(spark.createDataFrame([("n",)], "transaction_number string"), tables.LINE_VIEW)
    assert view.columns == tables.LINE_VIEW
    errors.error_view(frame(spark, error()), "%header%", tables.HEADER_ERROR_VIEW).collect()
    assert errors.error_view(frame(spark, error()), "%line_item%", tables.LINE_ERROR_VIEW).isEmpty()


def test_jdbc_options():
    database = jdbc.Database("jdbc:x", "d.Driver", {"user": "u"})
    assert jdbc.read_options(database, query="select 1")["query"] == "select 1"
    split = jdbc.read_options(database, query="select 1", ranges=jdbc.Ranges("id", "0", "9", 4))
    assert split["dbtable"] == "(select 1) q" and "query" not in split and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc.read_options(database)


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert jdbc.retried(flaky, tries=5, wait=0) == "done" and len(calls) == 3
    with pytest.raises(OSError):
        jdbc.retried(lambda: (_ for _ in ()).throw(OSError()), tries=2, wait=0)


def test_all_text(spark):
    assert jdbc.as_text(spark.range(1)).schema.simpleString() == "struct<id:string>"


def test_wildcards(spark):
    lookup = spark.createDataFrame([
        ("E", "C", "-", "-", "ANY"), ("E", "C", "S", "-", "ONE"), ("E", "C", "S", "P", "TWO"), ("E", "C", "S", "P", "THREE"),
        ("E", "C", "T", "-", "TEE"), ("F", "C", "S", "P", "ALONE")], "e string, c string, s string, p string, v string")
    rows = spark.createDataFrame([("E", "C", "S", "P"), ("E", "C", "S", "x"), ("E", "C", "z", "x"), ("E", "C", "NA", " "),
                                  ("E", "C", None, None), ("F", "C", "z", None), ("G", "C", "S", "P")], "ev string, cl string, sy string, pl string")
    found = lookups.wildcard_match(rows, lookup, {"ev": "e", "cl": "c"}, {"sy": "s", "pl": "p"}, "v")
    assert {(r["ev"], r["sy"], r["pl"]): (r["v"], r["error_message"] is not None) for r in found.collect()} == {
        ("E", "S", "P"): (None, True), ("E", "S", "x"): ("ONE", False), ("E", "z", "x"): ("ANY", False),
        ("E", "NA", " "): ("ANY", False), ("E", None, None): ("ANY", False), ("F", "z", None): ("ALONE", False), ("G", "S", "P"): ("@", False)}


def test_hierarchy(spark):
    nodes = spark.createDataFrame([("r", None, "Root", "0", 1), ("a", "r", "A", "0", 1), ("b", "a", "B", "1", 1), ("c", "b", "C", "1", 1),
                                   ("d", "r", "D", "1", 1)], "name string, parent string, description_us string, allow_posting string, cycle_date int")
    paths = hierarchy.level_paths(nodes, ["allow_posting"])
    assert values(paths, "name", "level", "level_1", "level_2", "level_4", "level_3") == [
        ("a", 2, "Root", "A", None, None), ("b", 3, "Root", "A", None, "B"), ("c", 4, "Root", "A", "C", "B"),
        ("d", 2, "Root", "D", None, None), ("r", 1, "Root", None, None, None)]
    assert values(hierarchy.leaves_below(nodes, "A"), "name") == [("b",), ("c",)]


TREE_ROW = "name string, parent string, description_us string, cycle_date int"


def test_paths_double(spark, monkeypatch):
    """25 levels in five rounds; several parents and cycles; nodes below no root are left out."""
    rounds = []
    plain = hierarchy.materialise
    monkeypatch.setattr(hierarchy, "materialise", lambda df, label: rounds.append(label) or plain(df, label))
    rows = [(f"n{i}", f"n{i - 1}" if i else None, f"N{i}", 1) for i in range(25)]
    rows += [("two", "n3", "Two", 1), ("two", "n20", "Two", 1), ("other", "gone", "Other", 1), ("n1", "n0", "Again", 2), ("n0", None, "Zero", 2)]
    found = hierarchy.level_paths(spark.createDataFrame(rows, TREE_ROW), [])
    assert len(rounds) == 6  # the rows themselves and five rounds
    got = {(r["name"], r["cycle_date"], r["level"]): [r[f"level_{i}"] for i in range(1, 26)] for r in found.collect()}
    assert len(got) == 25 + 2 + 2 and got[("n24", 1, 25)] == [f"N{i}" for i in range(25)]
    assert got[("two", 1, 5)] == ["N0", "N1", "N2", "N3", "Two"] + [None] * 20 and ("two", 1, 22) in got
    assert got[("n1", 2, 2)][:3] == ["Zero", "Again", None]


@pytest.mark.parametrize("loop", [1, 2, 3, 8, 13])
def test_loops_are_found(spark, loop):
    rows = [("root", None, "Root", 1), ("a", "root", "A", 1)]
    rows += [(f"x{i}", f"x{(i + 1) % loop}", "X", 1) for i in range(loop)] + [("below", "x0", "B", 1), ("below", "a", "B", 1)]
    with pytest.raises(ValueError, match="below itself"):
        hierarchy.level_paths(spark.createDataFrame(rows, TREE_ROW), [])


def test_schema_reconciliation(spark):
    h, li = spark.createDataFrame([], "a int, b int"), spark.createDataFrame([], "b int, c int")
    assert reshape.schema_differences(h, li) == (["a"], ["c"])
    assert reshape.with_missing(h, ["c", "a"]).columns == ["a", "b", "c"]
    with pytest.raises(ValueError):
        reshape.header_line_join(h, li, ["a"])


def test_key_results_match_null_groups(spark):
    schema = "operation string, fact_col_name string, group_col_name string, group_col_val string, fact_val int"
    s = spark.createDataFrame([("o", None, "g", None, 1), ("o", None, "g", "x", 2)], schema)
    t = spark.createDataFrame([("o", None, "g", None, 1), ("o", None, "g", "y", 2)], schema)
    found = controls.key_results(s, t, ["operation", "fact_col_name", "group_col_name", "group_col_val"])
    assert values(found, "group_col_val", "match_indicator") == [(None, "Y"), ("x", "N"), ("y", "N")]


def test_signs(spark):
    log = spark.createDataFrame([("m", "S", 10), ("m", "SA", 2), ("m", "A", 1), ("m", "SI", 3), ("m", "TI", 1), ("m", "TA", 4), ("m", "T", 7)],
                                "k string, tag string, fact_val int")
    assert controls.balance(log, ["k"]).first()["is_match"] == "Y"
    assert {r["side"]: int(r["adjustment"]) for r in controls.adjustments(log, ["k"]).collect()} == {"ADJ S": -6, "ADJ T": 3}


def test_additional_control(spark):
    df = spark.range(3).selectExpr("id as amount")
    for other, wanted in ((df, "MATCHING"), (df.limit(2), "NOT MATCHING")):
        assert controls.additional_control(df, other, "amount").first()["count_check"] == wanted
    assert controls.additional_control(df.limit(0), df.limit(0), "amount").first()["sum_check"] == "EMPTY"


def test_store_twice_is_once(spark, batch, error_table):
    from test_classify import RAW, raw, raw_row  # noqa: F401

    from quillbook.plans import load

    spark.sql("drop table if exists ledger_headers")
    empty = spark.createDataFrame([], "transaction_number string, source_system_nm string, cycle_date date, batch_id int")
    tables.create(spark, "ledger_headers", empty.schema, ["cycle_date", "batch_id"])
    final = spark.createDataFrame([("n1", "s", batch.cycle_date, 7)], empty.schema)
    outcome = load.Outcome(final, frame(spark), frame(spark), frame(spark, error()), final)
    load.store(outcome, batch, "ledger_headers", error_table)
    load.store(outcome, batch, "ledger_headers", error_table)
    assert spark.table("ledger_headers").count() == 1 and spark.table(error_table).count() == 1
    nothing = replace(outcome, final=final.where(F.lit(False)), soft=frame(spark))
    load.store(nothing, batch, "ledger_headers", error_table)
    assert spark.table("ledger_headers").isEmpty() and spark.table(error_table).isEmpty()


def test_no_level_and_no_parent_is_left_out(spark):
    rows = [("n0", None, "N0", 0, 1)] + [(f"n{i}", f"n{i - 1}", f"N{i}", 1, 1) for i in range(1, 26)] + [("n20", "n2", "N20", 1, 1)]
    nodes = spark.createDataFrame(rows, "name string, parent string, description_us string, allow_posting int, cycle_date int")
    paths = hierarchy.level_paths(nodes, [])
    assert paths.agg({"level": "max"}).first()[0] == 26 and "level_26" in paths.columns
    assert values(paths.where("name = 'n20'"), "level") == [(21,), (4,)]
    assert values(hierarchy.leaves_below(nodes, "N0").where("name = 'n20'"), "parent") == [("n19",), ("n2",)]


def test_a_loop_is_reported(spark):
    nodes = spark.createDataFrame(
        [("a", None, "A", 0, 1), ("b", "a", "B", 1, 1), ("c", "b", "C", 1, 1), ("b", "c", "B", 1, 1)],
        "name string, parent string, description_us string, allow_posting int, cycle_date int")
    with pytest.raises(ValueError, match="a > b > c > b"):
        hierarchy.level_paths(nodes, [])
    assert hierarchy.leaves_below(nodes, "A").count() == 3


def test_null_values_are_not_ambiguous(spark):
    lookup = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("b", "y"), ("c", None)], "k string, v string")
    assert values(lookups.one_or_ambiguous(lookup, ["k"], "v")) == [("a", "x"), ("b", "Q"), ("c", None)]


def test_fields_of_a_view_are_taken_at_once(spark):
    """As many fields as one wants, one call on the record; odd records give what each field alone gives."""
    records = ['{"a": "x", "b": 1.50, "c": {"d": [1, null]}}', '{"A": "upper", "b": null, "c": [true, "t"]}', '{"a": 1e400}', '"text"', "[1]", "3",
               "no json", "", None, "{}", '{"a": "x", "a": "y"}', '{"a": true, "b": "\\u00e9"}', '{"a": 12345678901234567890123456789012345678901}']
    rows = spark.createDataFrame(
        [(r, f"s{i}_lines", "Y", i) for i, r in enumerate(records)], "error_record string, table_name string, reprocess_flag string, original_batch_id int"
    ).selectExpr("*", *[f"cast(null as {kind}) {name}" for name, kind in (
        ("recorded_timestamp", "timestamp"), ("original_cycle_date", "date"), ("original_recorded_timestamp", "timestamp"),
        ("error_classification_name", "string"), ("error_message", "string"), ("error_record_aging_days", "int"))])
    names = ["a", "b", "c"]
    view = errors.error_view(rows, "%", names)
    alone = rows.select("original_batch_id", *[
        F.try_variant_get(F.try_parse_json("error_record"), f"$['{n}']", "string").alias(n) for n in names])
    assert values(view, "original_batch_id", *names) == values(alone)
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") == 1
