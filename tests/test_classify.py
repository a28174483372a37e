from dataclasses import replace
from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from quillbook.functions import groups
from quillbook.operators import classify, controls, errors
from quillbook.plans import load

RAW = ("cycle_date int, fsi_gl_pt_effective_date string, fsi_gl_bh_rev_effective_date string, fsi_gl_bh_application_area string, "
       "fsi_gl_pt_source_code string, fsi_gl_pt_company string, fsi_gl_pt_account string, fsi_gl_pt_amount string, "
       "fsi_gl_pt_dr_cr_code string, fsi_gl_pt_source_document_id string, fsi_gl_pt_center string, fsi_gl_pt_project_code string, "
       "fsi_gl_pt_description_1 string, fsi_gl_pt_description_2 string, fsi_gl_pt_description_3 string")


def raw_row(day="2025001", reversal=None, area="AR", source="041X", company="0101", account="1000", amount="100",
            code="10", doc="D1", center="C1", cycle=20251205):
    return (cycle, day, reversal, area, source, company, account, amount, code, doc, center, "P", "d1", "d2", "d3")


def raw(spark, *rows):
    return [spark.createDataFrame(list(rows), RAW)]


@pytest.fixture
def known(spark):
    forever = (date(2000, 1, 1), date(9999, 12, 31))
    subledgers = spark.createDataFrame([
        ("EV041AR", "SYS1", "AR", "041", "SL1", "Include", *forever),
        ("EV903AR", "SYS2", "AR", "903", "SL1", None, *forever),
        ("EV062AR", "SYS3", "AR", "062", "SL2", "Exclude", *forever),
        ("EVOLD00", "OLD", "AR", "041", "SL9", "Include", date(2000, 1, 1), date(2020, 1, 1)),
    ], "evnt_typ_cd string, src_sys_nm_desc string, actvty_gl_app_area_cd string, actvty_gl_src_cd string, "
       "subledger_nm string, include_exclude string, eff_strt_dt date, eff_stop_dt date")
    ledgers = spark.createDataFrame(
        [("01", "LEDGER1", "0101", "Include", *forever), ("02", "LEDGER2", "0102", "Include", *forever)],
        "actvty_gl_ldgr_cd string, ledger_nm string, sec_ldgr_cd string, include_exclude string, eff_strt_dt date, eff_stop_dt date")
    reinsurance = spark.createDataFrame(
        [("01", "C1", "T", "A", "AF", "B", "TB", "G", 1), ("01", "C1", "T", "NEW", "AF", "B", "TB", "G", 2)],
        "legal_entity string, center_code string, treaty_name string, reinsurance_assumed_ceded_flag string, "
        "reinsurance_account_flag string, reinsurance_basis string, type_of_business_reinsured string, "
        "reinsurance_group_individual_flag string, rcd_crtd_dt int")
    return load.Lookups(subledgers, ledgers, reinsurance)


def headers(spark, known, batch, *rows, carried=None):
    prepared = load.header_rows(raw(spark, *rows), known, batch, carried)
    return classify.classify_headers(prepared, batch)


def test_copies_make_one_header(spark, known, batch):
    rows = headers(spark, known, batch, raw_row(), raw_row(amount="7"), raw_row(source=" 041X "))
    assert values(rows, "error_cleared", "transaction_number_drvd") == [("Good", "EV041A20251208083015000_1")]


def test_messages_name_the_lookups_of_the_caller(spark, known, batch):
    named = replace(known, names=classify.LookupNames("sub_t", "led_t", "rei_t"))
    rows = [raw_row(source="999X"), raw_row(company="0199"), raw_row(source="903X", center="C9")]
    texts = [r["error_message"] for r in load.load_headers(raw(spark, *rows), named.written(), batch).rows.collect()]
    assert len(texts) == 3
    for name in ("sub_t", "led_t", "rei_t"):
        assert any(f"is missing in rdm table {name} for key combination" in t for t in texts)


def test_other_cycles_stay_out(spark, known, batch):
    assert headers(spark, known, batch, raw_row(cycle=20251204)).isEmpty()


def test_excluded_and_expired_lookups(spark, known, batch):
    assert headers(spark, known, batch, raw_row(source="062X")).isEmpty()
    row = headers(spark, known, batch, raw_row()).first()
    assert row["source_system_nm_drvd"] == "SYS1"


@pytest.mark.parametrize("change, message", [
    ({"day": "2025399"}, "2025399 transaction_date is in invalid format, expected yyyyjjj;"),
    ({"reversal": "x"}, "x gl_reversal_date is in invalid format, expected yyyyjjj;"),
    ({"day": "2025010", "reversal": "2025009"}, "2025010 > 2025009 transaction_date is greater than gl_reversal_date;"),
    ({"area": " "}, "gl_application_area_code is invalid from source;"),
    ({"area": None}, "blank/null gl_application_area_code is invalid from source;"),
    ({"source": "04"}, "04 gl_source_code is invalid from source;"),
    ({"company": "010"}, "010 secondary_ledger_code is invalid from source;"),
])
def test_hard_messages(spark, known, batch, change, message):
    row = headers(spark, known, batch, raw_row(**change)).first()
    assert row["hard_error_message"] == message
    assert (row["error_cleared"], row["reprocess_flag"], row["soft_error_message"]) == ("Hard Error", "N", "")


@pytest.mark.parametrize("change, part", [
    ({"source": "999X"}, "source_system_nm/event_type_code is missing"),
    ({"company": "0199"}, "ledger_name is missing"),
    ({"source": "903X", "center": "C9"}, "reinsuranceassumedcededflag is missing"),
])
def test_soft_messages(spark, known, batch, change, part):
    row = headers(spark, known, batch, raw_row(**change)).first()
    assert part in row["soft_error_message"] and "transaction_number is invalid;" in row["soft_error_message"]
    assert (row["error_cleared"], row["reprocess_flag"], row["hard_error_message"]) == ("Soft Error", "Y", "")


@pytest.mark.parametrize("reversal", [None, "", "0", "2025001"])
def test_reversal_may_be_left_out(spark, known, batch, reversal):
    assert headers(spark, known, batch, raw_row(reversal=reversal)).first()["error_cleared"] == "Good"


def test_one_member_spoils_its_header(spark, known, batch):
    rows = headers(spark, known, batch, raw_row(source="903X"), raw_row(source="903X", center="C9"))
    assert [r["transaction_number_drvd"] for r in rows.collect()] == [None, None]
    assert values(rows, "orig_gl_center", "soft_error_message")[0] == ("C1", "transaction_number is invalid;")


def test_date_error_forces_siblings(spark, known, batch):
    rows = headers(spark, known, batch, raw_row(), raw_row(day="2025399"), raw_row(source="903X"))
    found = {(r["gl_source_code"], r["transaction_date"]): r["hard_error_message"] for r in rows.collect()}
    assert found["041X", "2025001"].startswith(classify.FORCED_DATE + "AR) and gl_source_code (041);")
    assert found["903X", "2025001"] == ""


def test_rows_of_a_transaction_are_forced(spark, known, batch):
    rows = classify.force_transactions(
        headers(spark, known, batch, raw_row(source="999X"), raw_row(company="010"), raw_row()), batch, "transaction_number_drvd")
    found = {r["gl_source_code"] + r["secondary_ledger_code"]: r for r in rows.collect()}
    assert found["999X0101"]["error_cleared"] == "Soft Error"
    assert found["041X010"]["hard_error_message"].startswith(classify.FORCED_LOOKUP + "UNKNOWN;")
    assert found["041X0101"]["error_cleared"] == "Good"


def test_numbers_within_a_prefix_are_unique(spark, known, batch):
    rows = headers(spark, known, batch, *[raw_row(day=f"2025{d:03d}") for d in range(1, 30)])
    numbers = sorted(int(r["transaction_number_drvd"].split("_")[1]) for r in rows.collect())
    assert numbers == list(range(1, 30))


def both(spark, known, batch, *rows, carried=None, carried_lines=None):
    line_batch = replace(batch, domain="general_ledger_line_item")
    h = load.load_headers(raw(spark, *rows), known, batch, carried)
    return h, load.load_lines(raw(spark, *rows), known, h, line_batch, carried_lines), line_batch


ROWS = [
    raw_row(), raw_row(), raw_row(amount="50", doc="D2"), raw_row(amount="-5", doc="D3"), raw_row(amount="x", doc="D4"),
    raw_row(source="903X"), raw_row(source="903X", center="C9", day="2025002"), raw_row(source="999X"),
    raw_row(company="010"), raw_row(source="062X"), raw_row(account="9100"), raw_row(company="0102", day="2025399"),
    raw_row(company="0102", source="903Y", day="2025003", reversal="2025009"),
]


def test_lines_end_to_end(spark, known, batch):
    h, lines, _ = both(spark, known, batch, *ROWS[:11], ROWS[12])
    final = lines.final
    assert final.count() == 8
    assert final.select("transaction_number", "line_number").distinct().count() == 8
    assert final.select("activity_accounting_id").distinct().count() == 8
    amounts = {r["orig_gl_source_document_id"]: float(r["default_amount"]) for r in final.collect()}
    assert (amounts["D2"], amounts["D3"], amounts["D4"]) == (0.5, 0.0, 0.0)
    assert final.select("transaction_number").distinct().count() == h.final.count()
    assert values(lines.soft, "error_message") == [("Header Errored for RDM Lookup;",)] * 2
    identity = controls.row_identity(lines.rows).first()
    assert (identity["holds"], identity["source_rows"]) == ("Y", 11)


def test_lines_follow_forced_headers(spark, known, batch):
    _, lines, _ = both(spark, known, batch, *ROWS)
    forced = lines.rows.where(F.contains("hard_error_message", F.lit(classify.FORCED_DATE)))
    assert forced.where("gl_source_code_drvd = '041'").count() == 7
    assert forced.where("gl_source_code_drvd <> '041'").isEmpty()


def test_large_headers_are_numbered_alike(spark, known, batch):
    rows = [raw_row(doc=f"D{i % 40}") for i in range(200)] + ROWS[:11]
    _, plain, _ = both(spark, known, batch, *rows)
    wanted = values(plain.final.drop("activity_accounting_id"))
    spark.conf.set(groups.GROUP_ROWS, "60")
    try:
        _, cut, _ = both(spark, known, batch, *rows)
        assert values(cut.final.drop("activity_accounting_id")) == wanted
        assert cut.final.select("activity_accounting_id").distinct().count() == len(wanted)
    finally:
        spark.conf.unset(groups.GROUP_ROWS)


def test_errors_come_back_in_a_later_batch(spark, known, batch):
    h, lines, line_batch = both(spark, known, batch, raw_row(), raw_row(source="999X"), raw_row(source="999X", doc="D9"))
    nxt, nxt_lines = replace(batch, cycle_date=date(2025, 12, 8), batch_id=8), replace(line_batch, cycle_date=date(2025, 12, 8), batch_id=8)
    more = known.subledgers.where("actvty_gl_src_cd = '041'").limit(1).withColumns({
        "actvty_gl_src_cd": F.lit("999"), "evnt_typ_cd": F.lit("EV999AR"), "eff_stop_dt": F.lit(date(9999, 12, 31))})
    complete = replace(known, subledgers=known.subledgers.unionByName(more))
    none = [spark.createDataFrame([], RAW)]
    carried = load.carried_errors(h.soft, nxt, errors.HEADER_FIELDS)
    h2 = load.load_headers(none, complete, nxt, carried)
    carried = load.carried_errors(lines.soft, nxt_lines, errors.LINE_FIELDS)
    l2 = load.load_lines(none, complete, h2, nxt_lines, carried)
    assert values(h2.final, "original_cycle_date", "original_batch_id", "batch_id") == [(date(2025, 12, 5), 7, 8)]
    assert l2.final.count() == 2 and values(l2.final, "original_batch_id") == [(7,), (7,)]
    cleared = l2.cleared
    assert values(cleared, "error_classification_name", "reprocess_flag", "error_record_aging_days") == [("Cleared", "R", 0)] * 2
    record = cleared.select(F.get_json_object("error_record", "$.batch_id"), F.get_json_object("error_record", "$.old_error_message"))
    assert values(record) == [("8", "Header Errored for RDM Lookup;")] * 2
    assert h2.soft.isEmpty() and l2.soft.isEmpty()


def test_balance_of_the_curated_hop(spark, known, batch):
    _, lines, line_batch = both(spark, known, batch, *ROWS)
    from quillbook.operators import lookups
    from quillbook.sources import extracts as ex

    rows = ex.line_rows(raw(spark, *ROWS), line_batch.cycle_number)
    found = lookups.look_up(rows, *known.in_force(line_batch))
    excluded = found.where(lookups.is_excluded("sblgdr_include_exclude", "ldgr_include_exclude"))
    measures = [controls.Measure(controls.TOTAL_COUNT), controls.Measure(controls.SUM_TOTAL, "default_amount", "ignore_negative"),
                controls.Measure(controls.GROUPED_COUNT, "debit_credit_indicator")]
    target = [measures[0], controls.Measure(controls.SUM_TOTAL, "default_amount"), measures[2]]
    log = load.load_log(rows, excluded, lines, measures, line_batch, target)
    results = controls.balance(log, ["operation", "control_id", "group_col_val"])
    controls.require_matches(results)
    broken = load.load_log(rows, excluded.limit(0), lines, measures, line_batch, target)
    with pytest.raises(ValueError):
        controls.require_matches(controls.balance(broken, ["operation", "control_id", "group_col_val"]))
