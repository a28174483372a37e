"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbook.functions import codes, groups, identity, rules
from quillbook.operators import batches, cdc, classify, controls, errors, hierarchy, lookups, reshape, scd2
from quillbook.operators.batch import Batch
from quillbook.plans import load, warehouse
from quillbook.plans import workload as w
from quillbook.session import configure, control_table, materialise, stage_path
from quillbook.sources import extracts as ex
from quillbook.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Dates, booleans and decimals in types that every engine prints alike."""
    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.DateType, T.BooleanType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        with w.inputs():
            return comparable(function(configure(spark), folder))

    QUERIES[function.__name__] = run
    return function


def _text(df: DataFrame, *names: str) -> DataFrame:
    """Numbers that may be null as text."""
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def _raw(spark: SparkSession, folder: str) -> list[DataFrame]:
    return w.extracts(spark, folder)


def _known(spark: SparkSession, folder: str) -> load.Lookups:
    return load.Lookups(**w.lookups(spark, folder))


# Extracts, codes and lookups.


@query
def extract_headers(spark, folder):
    return ex.header_rows(_raw(spark, folder), w.LINE_BATCH.cycle_number)


@query
def extract_lines(spark, folder):
    return ex.line_rows(_raw(spark, folder), w.LINE_BATCH.cycle_number).drop("random_counter")


@query
def derived_codes(spark, folder):
    rows = classify.derive_codes(ex.line_rows(_raw(spark, folder), w.LINE_BATCH.cycle_number))
    return rows.select(
        "orig_gl_source_document_id", "gl_source_code_drvd", "secondary_ledger_code_drvd",
        "transaction_date_drvd", "gl_reversal_date_drvd", "transaction_date_chk", "gl_reversal_date_chk",
        codes.year_of("transaction_date", "yyyyDDD").alias("transaction_year"),
        *[codes.amount("default_amount", p).alias(p) for p in ("ignore_negative", "get_precision", "ignore_precision")],
    )


@query
def include_exclude(spark, folder):
    rows = ex.line_rows(_raw(spark, folder), w.LINE_BATCH.cycle_number)
    found = lookups.look_up(rows, *_known(spark, folder).in_force(w.LINE_BATCH))
    return found.groupBy("sblgdr_include_exclude", "ldgr_include_exclude").agg(
        F.count_if(lookups.is_included("sblgdr_include_exclude", "ldgr_include_exclude")).alias("included"),
        F.count_if(lookups.is_excluded("sblgdr_include_exclude", "ldgr_include_exclude")).alias("excluded"))


@query
def lookup_latest(spark, folder):
    orders = w.table(spark, folder, "orders")
    return ex.latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def lookup_second_latest(spark, folder):
    orders = w.table(spark, folder, "orders")
    return ex.nth_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 2)


# Null columns ask for nothing; some rows repeat with another value or with none.
WILDCARD_LOOKUP = """select case p_partkey % 3 when 0 then 'A' when 1 then 'N' else 'R' end as evnt_typ_cd,
 case when p_partkey % 17 = 3 then null when p_partkey % 2 = 0 then 'O' else 'F' end as trnsctn_cls,
 case when p_partkey % 7 < 3 then '-' else 'S' || cast(p_partkey % 4 as string) end as src_sys_nm,
 case when p_partkey % 5 < 2 then '-' when p_partkey % 5 = 4 then null else 'P' || cast(p_partkey % 5 as string) end as cntrct_pln_cd,
 case when p_partkey % 11 < 6 then '-' else 'F' || cast(p_partkey % 3 as string) end as fund_clss,
 case when p_partkey % 13 < 9 then '-' else 'R' || cast(p_partkey % 2 as string) end as trnsctn_rdr_typ,
 case when p_partkey % 19 < 16 then null else 'G' || cast(p_partkey % 2 as string) end as trnsctn_chrg_typ,
 case when p_partkey % 23 < 20 then '-' else 'E1' end as trnsctn_fee_typ, case when p_partkey % 29 < 26 then '-' else 'Q1' end as ifrs17_prtflio,
 case when p_partkey % 31 < 28 then '-' else 'U1' end as ifrs17_groupn,
 case when p_partkey % 6 = 5 then null else 'CF' || cast(p_partkey % 3 as string) || case when p_partkey % 7 = 5 then p_type else '' end end as cash_flow_type from part"""
WILDCARD_ROWS = """select l_returnflag as event_type_code, l_linestatus as transaction_class,
 'S' || cast(l_suppkey % 6 as string) as source_system_nm, 'P' || cast(l_partkey % 9 as string) as plancode,
 case when l_linenumber = 1 then 'NA' when l_linenumber = 2 then ' ' when l_linenumber > 3 then 'F' || cast(l_linenumber % 3 as string) end as fundclassindicator,
 'R' || cast(l_partkey % 3 as string) as rider_type, case when l_suppkey % 5 > 0 then 'G' || cast(l_suppkey % 2 as string) end as charge_type,
 'E' || cast(l_partkey % 2 as string) as fee_type, 'Q' || cast(l_suppkey % 2 as string) as portfolio, 'U' || cast(l_linenumber % 2 as string) as grouping
 from lineitem"""


@query
def wildcard_lookup(spark, folder):
    matched = lookups.wildcard_match(
        w.query(spark, folder, WILDCARD_ROWS), w.query(spark, folder, WILDCARD_LOOKUP),
        {"event_type_code": "evnt_typ_cd", "transaction_class": "trnsctn_cls"},
        {"source_system_nm": "src_sys_nm", "plancode": "cntrct_pln_cd", "fundclassindicator": "fund_clss",
         "rider_type": "trnsctn_rdr_typ", "charge_type": "trnsctn_chrg_typ", "fee_type": "trnsctn_fee_typ",
         "portfolio": "ifrs17_prtflio", "grouping": "ifrs17_groupn"},
        "cash_flow_type")
    return matched.groupBy(*matched.columns).agg(F.count(F.lit(1)).alias("rows"))


@query
def ambiguous_lookup(spark, folder):
    part = w.table(spark, folder, "part").withColumn("p_type", F.nullif("p_type", F.lit("PROMO BURNISHED COPPER")))
    return lookups.one_or_ambiguous(part, ["p_brand", "p_size"], "p_type")


# Every source prefix the rules name and one they do not, with accounts and texts that each condition tells apart.
_PREFIXES = """545 038 863 864 HIP 049 A4V 041 062 122 123 165 147 430 043 075 074 296 456 464 851 959 143 069 057 145 146 051 052 549 452 453
 454 458 460 462 463 141 073 039 668 077 402 109 017 903 444 999""".split()
_ACCOUNTS = """2872400 1872400 2861600 1861600 VOID123 2898000 2871100 2890200 2891900 2893600 28936001 1917300 9917300 2817300 4117300 4111300 4121300
 7117300 6117300 8290000 8250000 8490000 5117300 10A1200 2873600 1117300 1120300 1120500 2870500 2801800 2871300 2888900 1120400 1004100 1090900 1090600
 2890400 1997000 1910000 2878180 2893700 1110900 1806200 2872600 2872700 2886500 2890100 1017300 3117300""".split()
_FIRST = ["  ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "DTCCK and OTCKC in 30 letters here", "with NSCCK", "short", ""]
_SECOND = ["TA123", "N", "N12345", "T", "second text"]


def _pick(texts: list[str], key: str) -> str:
    return "case " + " ".join(f"when {key} % {len(texts)} = {i} then '{t}'" for i, t in enumerate(texts)) + " end"


RULE_ROWS = f"""select l_orderkey * 10 + l_linenumber as rn, {_pick(_PREFIXES, 'l_partkey')} || 'XY' as gl_full_source_code,
 {_pick(_ACCOUNTS, '(l_suppkey * 7 + l_orderkey)')} as orig_gl_account,
 case when l_linenumber < 7 then {_pick(_FIRST, '(l_orderkey + l_linenumber)')} end as orig_gl_description_1, {_pick(_SECOND, '(l_orderkey + l_suppkey)')} as orig_gl_description_2,
 'third ' || l_returnflag as orig_gl_description_3, 'DOC' || cast(l_orderkey * 1000003 as string) as orig_gl_source_document_id,
 'PROJ' || cast(l_suppkey as string) as orig_gl_project_code, 'C' || cast(l_partkey as string) as orig_gl_center from lineitem"""


@query
def attribute_rules(spark, folder):
    rows = w.query(spark, folder, RULE_ROWS)
    return rows.select("rn", *[c.alias(n) for n, c in rules.derived_attributes().items()])


@query
def orders_with_lines(spark, folder):
    return lookups.same_rows_present(
        w.table(spark, folder, "orders"),
        w.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query
def orders_without_lines(spark, folder):
    return lookups.same_rows_present(
        w.table(spark, folder, "orders"),
        w.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], missing=True)


@query
def comma_list(spark, folder):
    part = w.query(spark, folder, "select p_partkey, p_brand || ', ' || p_type || ',,' || p_name as natural_key_list from part")
    return lookups.listed(part, "natural_key_list", "value").groupBy("value").agg(F.count(F.lit(1)).alias("rows"))


# Classification.

HEADER_OUT = ["transaction_date", "gl_reversal_date", "gl_application_area_code", "gl_source_code",
              "secondary_ledger_code", "orig_gl_center", "data_type", "transaction_number_drvd",
              "hard_error_message", "soft_error_message", "reprocess_flag", "error_cleared"]
LINE_OUT = ["orig_gl_source_document_id", "gl_full_source_code", "secondary_ledger_code", "orig_gl_account",
            "default_amount_drvd", "debit_credit_indicator", "transaction_number", "line_number",
            "hard_error_message", "soft_error_message", "error_cleared"]


def _classified_headers(spark, folder):
    prepared = load.header_rows(_raw(spark, folder), _known(spark, folder), w.HEADER_BATCH)
    return classify.classify_headers(prepared, w.HEADER_BATCH)


@query
def classify_headers(spark, folder):
    return _classified_headers(spark, folder).select(*HEADER_OUT)


@query
def transaction_forced(spark, folder):
    rows = w.loaded_headers(spark, folder).rows
    return rows.groupBy("error_cleared", "reprocess_flag", "hard_error_message", "soft_error_message").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def final_headers(spark, folder):
    return _text(w.loaded_headers(spark, folder).final, "original_batch_id")


def _classified_lines(spark, folder):
    return load.classified_lines(
        _raw(spark, folder), _known(spark, folder), w.loaded_headers(spark, folder), w.LINE_BATCH)


@query
def classify_lines(spark, folder):
    return _text(_classified_lines(spark, folder).select(*LINE_OUT), "line_number")


@query
def classify_lines_summary(spark, folder):
    rows = _classified_lines(spark, folder)
    return rows.groupBy("error_cleared", "gl_application_area_code", "gl_source_code_drvd").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("default_amount_drvd").alias("amount"),
        F.max("line_number").cast("string").alias("last_line"))


@query
def line_attributes(spark, folder):
    lines = w.loaded_lines(spark, folder).final
    return lines.drop("activity_accounting_id", "recorded_timestamp", "original_cycle_date", "original_batch_id")


@query
def accounting_ids(spark, folder):
    lines = w.loaded_lines(spark, folder).final
    number = F.col("activity_accounting_id")
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct(number).alias("ids"),
        F.count_if((F.length(number) == 30) & number.rlike("^20251208[01]{2}[0-9]{20}$")).alias("well_formed"))


@query
def line_numbering(spark, folder):
    lines = w.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    order = ["l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    return groups.number_rows(lines, ["l_orderkey"], order, "line_number")


# Errors.


@query
def error_view(spark, folder):
    lines = w.loaded_lines(spark, folder)
    view = errors.error_view(lines.hard.unionByName(lines.soft), "%general_ledger_line_item%", errors.LINE_FIELDS)
    return view.drop("error_record", "original_recorded_timestamp", "recorded_timestamp")


@query
def error_records(spark, folder):
    """Headers in error, written as JSON and read back with their derived codes."""
    headers = w.loaded_headers(spark, folder)
    rows = headers.hard.unionByName(headers.soft)
    exploded = errors.explode_errors(rows, [*errors.HEADER_FIELDS, "drvd_data"])
    derived = exploded.withColumn("_d", F.from_json("drvd_data", "ledger_name_drvd string, transaction_date_drvd string"))
    return derived.select("error_classification_name", "reprocess_flag", "error_record_aging_days",
                          *errors.HEADER_FIELDS, "_d.ledger_name_drvd", "_d.transaction_date_drvd")


@query
def reprocess_errors(spark, folder):
    """The next batch: no new rows, all soft header errors tried again with complete lookups."""
    headers = w.loaded_headers(spark, folder)
    nxt = Batch("core", "general_ledger_header", date(2025, 12, 8), 700043, w.RUN_TS)
    carried = load.carried_errors(headers.soft, nxt, errors.HEADER_FIELDS)
    known = w.lookups(spark, folder)
    complete = load.Lookups(
        w.query(spark, folder, w.COMPLETE_SUBLEDGER_SQL),
        w.query(spark, folder, w.COMPLETE_LEDGER_SQL),
        known["reinsurance"])
    empty = [e.where(F.lit(False)) for e in _raw(spark, folder)]
    rows = classify.classify_headers(load.header_rows(empty, complete, nxt, carried), nxt)
    return rows.groupBy("error_cleared", "gl_source_code_drvd", "original_batch_id").agg(F.count(F.lit(1)).alias("rows"))


NEXT_BATCH = Batch("core", "general_ledger_header", w.CYCLE, 700043, w.RUN_TS)


@query
def reprocessed_with_new(spark, folder):
    """A second batch of the day, by complete lookups: all its new headers and the soft errors of the first batch."""
    carried = load.carried_errors(w.loaded_headers(spark, folder).soft, NEXT_BATCH, errors.HEADER_FIELDS)
    complete = load.Lookups(w.query(spark, folder, w.COMPLETE_SUBLEDGER_SQL), w.query(spark, folder, w.COMPLETE_LEDGER_SQL),
                            w.lookups(spark, folder)["reinsurance"])
    rows = classify.classify_headers(load.header_rows(_raw(spark, folder), complete, NEXT_BATCH, carried), NEXT_BATCH)
    return rows.select(*[c for c in HEADER_OUT if c != "reprocess_flag"], "original_batch_id")


def _error_view(rows: DataFrame, like: str, fields: list[str]) -> DataFrame:
    """The view, its record replaced by two of the derived codes that are nested in it."""
    derived = F.try_parse_json(F.try_variant_get("error_record", "$.drvd_data", "string"))
    return errors.error_view(rows, like, fields).select(
        "*", *[F.try_variant_get(derived, f"$.{n}", "string").alias(n) for n in ("ledger_name_drvd", "source_system_nm_drvd")],
    ).drop("error_record")


@query
def header_error_view(spark, folder):
    headers = w.loaded_headers(spark, folder)
    return _error_view(headers.hard.unionByName(headers.soft), "%general_ledger_header%", tables.HEADER_ERROR_VIEW)


@query
def line_error_view(spark, folder):
    lines = w.loaded_lines(spark, folder)
    return _error_view(lines.hard.unionByName(lines.soft), "%general_ledger_line_item%", tables.LINE_ERROR_VIEW)


AGED_ERRORS = """select o_orderpriority || '_general_ledger_header' as table_name, cast(o_orderdate as date) as original_cycle_date, case when o_orderstatus = 'F' then 'N' else 'Y' end as reprocess_flag from orders
 union all select o_orderpriority || '_general_ledger_line_item', cast(l_shipdate as date), case when l_linestatus = 'F' or o_orderpriority in ('2-HIGH', '5-LOW') then 'N' else 'Y' end from lineitem join orders on l_orderkey = o_orderkey"""


@query
def aged_pairs(spark, folder):
    return errors.aged_pairs(w.query(spark, folder, AGED_ERRORS), F.lit(date(2001, 8, 5)), max_days=400)


ERROR_BATCH = Batch("tpch", "general_ledger_header", date(2001, 8, 5), 200108, w.RUN_TS)


def _order_errors(spark, folder) -> DataFrame:
    """Every order as an error record: open orders soft, finished ones hard, partial ones cleared."""
    orders = w.table(spark, folder, "orders").withColumn("cycle", F.col("o_orderdate").cast("date"))
    status = F.col("o_orderstatus")
    cleared_by = F.when(status == "P", F.col("cycle")).cast("string")
    record = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("order_key"), F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").cast("string").alias("customer"), cleared_by.alias("cycle_date"),
        F.when(status == "P", F.date_format("cycle", "yyyyMM").cast("int")).alias("batch_id"),
        F.when(status == "P", F.concat(F.lit("was open "), F.col("o_orderpriority"))).alias("old_error_message")))
    return orders.select(
        F.lit(w.RUN_TS).alias("recorded_timestamp"), F.col("o_orderdate").cast("timestamp").alias("original_recorded_timestamp"),
        F.col("cycle").alias("original_cycle_date"), F.date_format("cycle", "yyyyMM").cast("int").alias("original_batch_id"),
        F.when(status == "O", "Soft").when(status == "F", "Hard").otherwise("Cleared").alias("error_classification_name"),
        F.when(status == "P", None).otherwise(F.col("o_orderpriority")).alias("error_message"),
        F.datediff(F.lit(ERROR_BATCH.cycle_date), F.col("cycle")).alias("error_record_aging_days"),
        record.alias("error_record"), F.lit(ERROR_BATCH.table_name).alias("table_name"),
        F.when(status == "O", "Y").when(status == "F", "N").otherwise("R").alias("reprocess_flag"),
    )


ORDER_SCHEMA = ("STRUCT<order_key: STRING, priority: STRING, customer: STRING, cycle_date: STRING, "
                "batch_id: BIGINT, old_error_message: STRING>")


def _fields(df: DataFrame, *names: str) -> DataFrame:
    return df.select(
        *[c for c in ("error_classification_name", "error_message", "reprocess_flag", "error_record_aging_days") if c in df.columns],
        *[F.get_json_object("error_record", f"$.{n}").alias(n) for n in names])


@query
def age_soft_errors(spark, folder):
    aged = errors.age_soft_errors(_order_errors(spark, folder), ERROR_BATCH, ORDER_SCHEMA, max_days=400)
    return _fields(aged, "order_key", "cycle_date", "batch_id")


@query
def reinstate_processed(spark, folder):
    batch = Batch("tpch", "general_ledger_header", date(1998, 6, 15), 199806, w.RUN_TS)
    return _fields(errors.reinstate_processed(_order_errors(spark, folder), batch, ORDER_SCHEMA),
                   "order_key", "cycle_date", "batch_id")


@query
def reinstate_hard(spark, folder):
    """Hard errors without those of one batch, and aged ones of that batch soft again."""
    batch = Batch("tpch", "general_ledger_header", date(1998, 6, 15), 199806, w.RUN_TS)
    rows = _order_errors(spark, folder)
    aged = errors.age_soft_errors(rows, batch, ORDER_SCHEMA, max_days=1500).where("reprocess_flag = 'N'")
    hard = rows.where("reprocess_flag = 'N'").unionByName(aged)
    return _fields(errors.reinstate_errors(hard, batch, errors.HARD, ORDER_SCHEMA, rerun=True), "order_key", "cycle_date")


@query
def json_field_edits(spark, folder):
    rows = _order_errors(spark, folder)
    rows = errors.add_field(rows, "source", F.lit("ledger"), ORDER_SCHEMA)
    schema = ORDER_SCHEMA[:-1] + ", source: STRING>"
    rows = errors.rename_fields(rows, {"priority": "urgency", "absent": "none"}, schema)
    schema = schema.replace("priority", "urgency")
    rows = errors.update_field(rows, "customer", "concat('C', parsed_json.customer)", schema)
    return _fields(rows, "order_key", "source", "priority", "urgency", "customer")


@query
def inferred_error_fields(spark, folder):
    """Records read with the schema found in the data."""
    rows = _order_errors(spark, folder)
    parsed = rows.select(F.from_json("error_record", errors.error_schema(rows)).alias("r")).select("r.*")
    return _text(parsed, "batch_id").groupBy("priority", "batch_id").agg(F.count(F.lit(1)).alias("rows"))


def _error_batches(spark, folder) -> DataFrame:
    return w.table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("cycle_date"), F.lit("tpch").alias("source_system")).distinct()


@query
def error_summary(spark, folder):
    details = errors.error_details(_order_errors(spark, folder), _error_batches(spark, folder))
    return errors.report_order(errors.error_summary(details))


@query
def error_report_by_source(spark, folder):
    """Errors of the days on which one system has daily batches of the domain."""
    batches_of = w.query(spark, folder, """select cast(o_orderdate as date) as cycle_date, o_orderpriority as source_system, case when o_custkey % 2 = 0 then 'headers' else 'lines' end as domain_name,
      case when o_orderkey % 3 = 0 then 'MONTHLY' else 'DAILY' end as batch_frequency from orders""")
    details = errors.error_details(_order_errors(spark, folder), batches_of, "1-URGENT", "headers", "DAILY", ["tpch_general_ledger_header"])
    return errors.report_order(errors.error_summary(details))


@query
def missing_references(spark, folder):
    return errors.missing_references(errors.error_details(_order_errors(spark, folder), _error_batches(spark, folder)))


@query
def forced_error_counts(spark, folder):
    headers, lines = w.loaded_headers(spark, folder), w.loaded_lines(spark, folder)
    return errors.forced_counts(headers.hard.unionByName(lines.hard))


@query
def error_view_stats(spark, folder):
    lines = w.loaded_lines(spark, folder)
    view = errors.error_view(lines.hard.unionByName(lines.soft), "%general_ledger_line_item%", [])
    return errors.view_stats(view)


@query
def reprocessed_summary(spark, folder):
    """Orders as headers that came back from an earlier date, with their lines."""
    orders = w.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_number"), F.col("o_orderdate").cast("date").alias("cycle_date"),
        F.lit(1).alias("batch_id"), F.col("o_orderstatus").alias("ledger_name"),
        F.when(F.col("o_orderstatus") != "F", F.add_months(F.trunc("o_orderdate", "month"), -1)).alias("original_cycle_date"),
        F.when(F.col("o_orderstatus") != "F", 1).alias("original_batch_id"))
    keys = ["transaction_number", "cycle_date", "batch_id", "original_cycle_date", "original_batch_id"]
    lines = w.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "transaction_number").join(
        orders.select(*keys), "transaction_number")
    return errors.reprocessed_summary(orders, lines, ["ledger_name"])


# Changes and deletes.

SPLIT = date(1999, 1, 1)
CDC_BATCH = Batch("tpch", "orders", SPLIT, 2, w.RUN_TS)
CDC_FIELDS = ["o_orderstatus", "o_orderpriority"]


def _loaded_orders(spark, folder) -> DataFrame:
    orders = w.table(spark, folder, "orders")
    return orders.where(F.col("o_orderdate") < F.lit(SPLIT)).select(
        "o_custkey", *CDC_FIELDS, F.col("o_orderdate").cast("date").alias("cycle_date"),
        F.lit(1).alias("batch_id"), "o_orderkey")


def _new_orders(spark, folder) -> DataFrame:
    orders = w.table(spark, folder, "orders").where(F.col("o_orderdate") >= F.lit(SPLIT))
    return ex.latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", *CDC_FIELDS)


@query
def cdc_actions(spark, folder):
    loaded = ex.latest(_loaded_orders(spark, folder), ["o_custkey"], ["cycle_date", "o_orderkey"])
    acted = cdc.change_actions(_new_orders(spark, folder), loaded, ["o_custkey"], CDC_FIELDS, CDC_BATCH)
    return acted.drop("recorded_timestamp")


@query
def cdc_after_delete(spark, folder):
    """Documents that an earlier batch deleted come back; nulls and empty texts differ."""
    blank = F.col("o_custkey") % 5 == 0
    loaded = ex.latest(_loaded_orders(spark, folder), ["o_custkey"], ["cycle_date", "o_orderkey"]).withColumn(
        "o_orderpriority", F.when(~blank, F.col("o_orderpriority")))
    new = _new_orders(spark, folder).withColumn("o_orderpriority", F.when(blank, "").otherwise(F.col("o_orderpriority")))
    deletes = loaded.where("o_custkey % 3 < 2").select("o_custkey", (F.col("o_custkey") % 3 + 1).alias("batch_id"))
    acted = cdc.change_actions(new, loaded, ["o_custkey"], CDC_FIELDS, CDC_BATCH, deletes)
    return acted.select("o_custkey", "o_orderkey", "cdc_action")


@query
def delete_detection(spark, folder):
    loaded = _loaded_orders(spark, folder).select(
        F.col("o_custkey").alias("documentid"), F.lit(SPLIT).alias("cycle_date"), F.lit(2).alias("batch_id"))
    final = _new_orders(spark, folder).withColumnRenamed("o_custkey", "documentid")
    return cdc.missing_keys(loaded, final, CDC_BATCH).drop("recorded_timestamp")


@query
def coded_deletes(spark, folder):
    rows = w.query(spark, folder, "select o_custkey as documentid, case when o_orderstatus = 'P' then 'DELT' when o_orderstatus = 'O' then 'UPDT' end as operationcode from orders")
    deletes = cdc.coded_deletes(rows, CDC_BATCH).select("documentid", "pointofviewstopdate")
    kept = cdc.without_deletes(rows).groupBy("documentid").agg(F.count(F.lit(1)).alias("kept"))
    return deletes.join(kept, "documentid", "full_outer").select(
        "documentid", "pointofviewstopdate", F.coalesce("kept", F.lit(0)).alias("kept"))


@query
def one_per_document(spark, folder):
    rows = w.table(spark, folder, "orders")
    return cdc.one_per_document(rows, ["o_custkey"], ["o_orderpriority", "o_orderkey"])


@query
def dropped_copies(spark, folder):
    return cdc.dropped_copies(w.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def expired_contracts(spark, folder):
    orders = w.table(spark, folder, "orders")
    seen = orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("policy_id"), F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("policy_no"),
        F.lit("orders").alias("domain_name"), F.lit("tpch").alias("source_system"), F.col("o_orderdate").cast("date").alias("cycle_date"))
    expired = w.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("policy_id"), F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("policy_no"))
    fresh = cdc.newly_expired(expired, seen, Batch("tpch", "orders", date(1995, 6, 1), 3, w.RUN_TS))
    return fresh.drop("recorded_timestamp")


# History.

FIELDS = ["event_type"]
HALF = date(2024, 1, 16)


def _daily(spark, folder) -> DataFrame:
    """The last event of each user and day as that day's version of the user."""
    events = w.table(spark, folder, "events").withColumn("cycle_date", F.col("ts").cast("date"))
    last = ex.latest(events, ["user_id", "cycle_date"], ["ts", "event_id"])
    return last.select("user_id", "event_type", "cycle_date", F.date_format("cycle_date", "yyyyMMdd").cast("bigint").alias("batch_id"))


def _staged(rows: DataFrame, steps=scd2.Steps()) -> DataFrame:
    named = rows.select("cycle_date", "batch_id").distinct()
    return scd2.staging_type2(rows, named, ["user_id"], FIELDS, steps)


def _empty(staging: DataFrame) -> DataFrame:
    return staging.where(F.lit(False))


def _first_half(spark, folder) -> DataFrame:
    """History after the first half of the days: a table the queries start from."""
    def load_first():
        staging = _staged(_daily(spark, folder).where(F.col("cycle_date") < F.lit(HALF)))
        return scd2.apply_working(_empty(staging), scd2.working_type2(staging, _empty(staging)))

    return w.written(spark, folder, "history", load_first)


def _history(spark, folder) -> DataFrame:
    """History of all days."""
    def load_second():
        first = _first_half(spark, folder)
        return scd2.apply_working(first, scd2.working_type2(_second_half(spark, folder), first))

    return w.written(spark, folder, "history of all days", load_second)


def _second_half(spark, folder) -> DataFrame:
    return _staged(_daily(spark, folder).where(F.col("cycle_date") >= F.lit(HALF)))


VERSION_OUT = ["user_id", "event_type", scd2.START, scd2.STOP, scd2.BATCH]


@query
def staging_hashes(spark, folder):
    return _staged(_daily(spark, folder)).select("user_id", scd2.KEY, scd2.HASH, scd2.START, scd2.STOP, scd2.BATCH)


@query
def scd2_working(spark, folder):
    working = scd2.working_type2(_second_half(spark, folder), _first_half(spark, folder))
    return working.select(*VERSION_OUT, scd2.ACTION, scd2.SOURCE)


FIRST_LOAD, SECOND_LOAD = 20240115, 20240131


def _logged(spark, folder) -> warehouse.History:
    """History of the first half as a log of loads."""
    first = _first_half(spark, folder)
    history = warehouse.History.create(spark, stage_path(spark, "history-log"), first.schema)
    history.adopt(first, FIRST_LOAD)
    return history


@query
def scd2_history(spark, folder):
    """The second half loaded on top of the first; open versions meet their closures when read."""
    history = _logged(spark, folder)
    history.load(_second_half(spark, folder), SECOND_LOAD)
    return history.versions().select(*VERSION_OUT)


@query
def history_loads(spark, folder):
    """Three loads, and what each of them wrote: versions and closures."""
    staging = materialise(_staged(_daily(spark, folder)), "staging")
    history = warehouse.History.create(spark, stage_path(spark, "history-log"), staging.schema)
    for low, high in ((0, 20240110), (20240110, 20240120), (20240120, 20240231)):
        history.load(staging.where((F.col(scd2.BATCH) > low) & (F.col(scd2.BATCH) <= high)), high)
    return history.commits().where("kind = 'load'").select("kind", "batch", "cycle", "newest", "versions", "closures")


@query
def compacted_history(spark, folder):
    """Loads, deletes and a compaction; then another delete, which meets compacted versions."""
    history = _logged(spark, folder)
    history.load(_second_half(spark, folder), SECOND_LOAD)
    versions = history.versions()
    history.delete(versions.where("event_type = 'error'").select(
        F.col(scd2.KEY).alias("documentid"), F.lit(date(2024, 2, 15)).alias("pointofviewstopdate")), 20240215)
    history.compact()
    history.vacuum()
    history.delete(history.in_force().where("event_type = 'click'").select(
        F.col(scd2.KEY).alias("documentid"), F.lit(date(2024, 2, 20)).alias("pointofviewstopdate")), 20240220)
    return history.versions().select(*VERSION_OUT)


@query
def replay_balance(spark, folder):
    """The load of the second half measured against its replay, per batch: new, ended and repeated versions."""
    history, staging = _logged(spark, folder), materialise(_second_half(spark, folder), "staging")
    before = history.in_force()
    history.load(staging, SECOND_LOAD)
    named = staging.select(F.col(scd2.CYCLE).alias("cycle_date"), F.col(scd2.BATCH).alias("batch_id")).distinct()
    fields = ["user_id", "event_type", scd2.START]
    rows = warehouse.replayed(staging, before, history, history.closed_by([SECOND_LOAD]), named, fields)
    measures = [controls.Measure(controls.TOTAL_COUNT), controls.Measure(controls.DISTINCT_COUNT, "event_type"),
                controls.Measure(controls.SUM_TOTAL, "user_id"), controls.Measure(controls.SUM_YEAR, scd2.START),
                controls.Measure(controls.GROUPED_COUNT, "event_type")]
    return warehouse.balance_replay(rows, measures, "users")


@query
def scd2_intraday(spark, folder):
    events = w.table(spark, folder, "events").withColumn("cycle_date", F.col("ts").cast("date"))
    hourly = ex.latest(events.withColumn("hour", F.hour("ts")), ["user_id", "cycle_date", "hour"], ["ts", "event_id"])
    rows = hourly.select("user_id", "event_type", "cycle_date",
                         (F.date_format("cycle_date", "yyyyMMdd").cast("bigint") * 100 + F.col("hour")).alias("batch_id"))
    steps = scd2.Steps(intraday=True)
    staging = _staged(rows, steps)
    working = scd2.working_type2(staging, _empty(staging), steps)
    return working.select(*VERSION_OUT, scd2.ACTION)


@query
def scd2_expected(spark, folder):
    """Several versions a day: what the load of the second half should do."""
    ts = F.col("ts")
    hourly = w.table(spark, folder, "events").withColumn("cycle_date", F.to_date(ts)).withColumn(
        "batch_id", F.date_format(ts, "yyyyMMddHH").cast("bigint"))
    hourly = ex.latest(hourly, ["user_id", "batch_id"], ["ts", "event_id"]).where(F.col("cycle_date") >= F.lit(date(2024, 1, 16)))
    working = scd2.expected_outcome(_staged(hourly), _first_half(spark, folder), group=["user_id"])
    return working.select(*VERSION_OUT, scd2.ACTION, scd2.SOURCE)


@query
def scd2_deletes(spark, folder):
    history = _logged(spark, folder)
    history.load(_second_half(spark, folder), SECOND_LOAD)
    history.delete(history.versions().where("event_type = 'error'").select(
        F.col(scd2.KEY).alias("documentid"), F.lit(date(2024, 2, 15)).alias("pointofviewstopdate")), 20240215)
    return history.versions().select(*VERSION_OUT)


@query
def deleted_parents(spark, folder):
    versions = _history(spark, folder).withColumn("documentid", F.col("user_id"))
    closed = scd2.close_deleted(versions, versions.where(F.col("event_type") == "click").select(
        F.col(scd2.KEY).alias("documentid"), F.lit(date(2024, 2, 15)).alias("pointofviewstopdate")))
    return scd2.deleted_parents(closed)


@query
def closed_by_batch(spark, folder):
    history = _first_half(spark, folder)
    working = scd2.working_type2(_second_half(spark, folder), history)
    named = _daily(spark, folder).select("cycle_date", "batch_id").distinct()
    closed = scd2.closed_by_batch(scd2.apply_working(history, working), working, named)
    return closed.select("closing_batch", *VERSION_OUT)


@query
def lookup_asof(spark, folder):
    history = _history(spark, folder).select("user_id", F.col("event_type").alias("version"), scd2.START, scd2.STOP)
    events = w.table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("cycle_date"))
    found = lookups.as_of(events, history, ["user_id"], "cycle_date", scd2.START, scd2.STOP)
    return found.select("event_id", "user_id", "version")


@query
def append_history(spark, folder):
    """Orders loaded, then the batches of one status loaded again with other rows."""
    orders = w.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").cast("bigint").alias(scd2.BATCH))
    again = orders.where(F.col("o_orderstatus") == "P")
    reloaded = scd2.working_append(again.withColumn("o_orderkey", -F.col("o_orderkey")))
    named = again.select(scd2.BATCH, "o_orderstatus").distinct()
    return scd2.append_to_history(orders, reloaded, named, [scd2.BATCH, "o_orderstatus"])


@query
def touched_documents(spark, folder):
    month = "cast(year({0}) * 100 + month({0}) as bigint) as batchid, 'S' as source_system_name, cast({0} as date) as pointofviewstartdate, date '9999-12-31' as pointofviewstopdate"
    contracts = w.query(spark, folder, f"select o_orderkey as documentid, {month.format('o_orderdate')} from orders")
    links = w.query(spark, folder, f"select l_orderkey as contract_documentid, l_suppkey as party_documentid, {month.format('l_shipdate')} from lineitem")
    parties = w.query(spark, folder, "select s_suppkey as documentid, 199800 + s_suppkey % 40 as batchid, 'S' as source_system_name from supplier")
    current = w.query(spark, folder, "select distinct date '1998-06-30' as cycle_date, cast(199806 as bigint) as batch_id, 'S' as source_system_name from region")
    return scd2.touched_documents(current, contracts, links, parties).select("documentid", "batchid", "for_batch")


SYSTEM_CONTRACTS = """select o_orderkey as documentid, cast(year(o_orderdate) * 100 + month(o_orderdate) as bigint) as batchid, o_orderpriority as source_system_name,
 cast(o_orderdate as date) as pointofviewstartdate, case when o_orderkey % 3 = 0 then date '9999-12-31' else date_add(cast(o_orderdate as date), 90 + cast(o_custkey % 400 as int)) end as pointofviewstopdate from orders"""
SYSTEM_LINKS = """select l_orderkey as contract_documentid, l_suppkey as party_documentid, cast(year(l_shipdate) * 100 + month(l_shipdate) as bigint) as batchid, o_orderpriority as source_system_name,
 case when l_linenumber < 3 then 'Primary Insured' else 'Owner' end as relationshiptype, cast(l_shipdate as date) as pointofviewstartdate,
 date_add(cast(l_shipdate as date), 30 * l_linenumber) as pointofviewstopdate from lineitem join orders on l_orderkey = o_orderkey"""
SYSTEM_PARTIES = """select distinct s_suppkey as documentid, cast(199401 + 100 * (s_suppkey % 6) + s_suppkey % 12 as bigint) as batchid, o_orderpriority as source_system_name
 from supplier join orders on s_suppkey % 50 = o_custkey % 50"""
SYSTEM_BATCHES = """select distinct last_day(cast(o_orderdate as date)) as cycle_date, cast(year(o_orderdate) * 100 + month(o_orderdate) as bigint) as batch_id, o_orderpriority as source_system_name
 from orders where (year(o_orderdate) * 12 + month(o_orderdate)) % 17 = 5 and o_orderpriority <> '3-MEDIUM'"""


def _system_parties(spark, folder) -> DataFrame:
    """``SYSTEM_PARTIES``, which is distinct and asks an order for its priority and its customer's remainder only.

    So the orders are reduced to these first: joined as they are, every supplier meets a fixed share of all orders.
    """
    asked = w.query(spark, folder, "select o_custkey % 50 as o_custkey, o_orderpriority from orders")
    return w.query(spark, folder, SYSTEM_PARTIES, orders=control_table(asked))


@query
def touched_by_batches(spark, folder):
    """Several batches of several systems, parties through primary insured only."""
    contracts, links, current = (w.query(spark, folder, t) for t in (SYSTEM_CONTRACTS, SYSTEM_LINKS, SYSTEM_BATCHES))
    parties = _system_parties(spark, folder)
    found = scd2.touched_documents(current, contracts, links, parties, kind="Primary Insured")
    return found.select("documentid", "batchid", "for_batch", "source_system_name")


# Batches.

TRACKING = """select event_type as source_system_name, 'dom' || cast(user_id % 4 as string) as domain_name,
 cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as bigint) as batch_id, cast(ts as date) as cycle_date,
 'datawarehouse' as phase_name, case when value < 60 then 'complete' else 'failed' end as load_status,
 ts as insert_timestamp, event_id from events"""


def _tracking(spark, folder) -> DataFrame:
    return w.query(spark, folder, TRACKING)


def _bases(spark, folder) -> DataFrame:
    return _tracking(spark, folder).where("domain_name in ('dom0', 'dom1', 'dom2')").select("source_system_name", "domain_name").distinct()


def _used(spark, folder) -> DataFrame:
    """Base batches of the first ten days have been used by the derived domain."""
    return _tracking(spark, folder).where(F.col("cycle_date") <= F.lit(date(2024, 1, 10))).select(
        F.col("source_system_name").alias("base_source_system_name"), F.col("domain_name").alias("base_domain_name"),
        F.col("batch_id").alias("base_batch_id"), "cycle_date", "insert_timestamp",
        F.lit("Y").alias("curated_load_complete_flag"))


def _pending(spark, folder) -> DataFrame:
    return batches.pending_base_batches(
        _tracking(spark, folder), _used(spark, folder), _bases(spark, folder), date(2024, 1, 5))


@query
def finished_batches(spark, folder):
    done = batches.finished(_tracking(spark, folder).withColumn("insert_timestamp", F.struct("insert_timestamp", "event_id")), "datawarehouse")
    return done.select("source_system_name", "domain_name", "batch_id", "event_id")


@query
def current_batches(spark, folder):
    return _pending(spark, folder)


def _completed(spark, folder) -> DataFrame:
    """Completed numbers: one for each day up to the middle of the month."""
    days = _tracking(spark, folder).where(F.col("cycle_date") <= F.lit(HALF)).select("cycle_date").distinct()
    return days.select(
        F.concat(F.date_format("cycle_date", "yyyyMMdd"), F.lit("000421")).cast("bigint").alias("batch_id"), "cycle_date",
        F.lit("derived").alias("domain_name"), F.lit("hub").alias("source_system"), F.lit("DAILY").alias("batch_frequency"))


def _derived(spark, folder) -> DataFrame:
    return batches.derived_batch_ids(_pending(spark, folder), _completed(spark, folder), 42, "hub", "derived", "DAILY")


@query
def batch_ids(spark, folder):
    return _derived(spark, folder)


@query
def last_completed(spark, folder):
    return batches.last_completed(_completed(spark, folder))


@query
def newly_completed(spark, folder):
    current = batches.current_batches(_derived(spark, folder), F.lit(w.RUN_TS))
    done = current.where(F.dayofmonth("cycle_date") < 20)
    return batches.newly_completed(current, done, F.lit(w.RUN_TS)).drop("recorded_timestamp")


@query
def next_batch(spark, folder):
    current = batches.current_batches(_derived(spark, folder), F.lit(w.RUN_TS))
    done = current.where(F.dayofmonth("cycle_date") < 18)
    return batches.next_batch(current, done)


@query
def ready_dates(spark, folder):
    return batches.ready_dates(_tracking(spark, folder), _bases(spark, folder), F.lit(20240110))


@query
def batch_count_mismatches(spark, folder):
    pending = _tracking(spark, folder).withColumn("batch_id", F.col("batch_id") * 100 + F.hour("insert_timestamp"))
    expected = pending.groupBy("source_system_name").agg(F.lit(23).cast("bigint").alias("number_of_batches"))
    return batches.batch_count_mismatches(pending, expected)


@query
def base_coverage(spark, folder):
    done = _tracking(spark, folder).where("load_status = 'failed'")
    wanted = [(s, d) for s in ("click", "error", "view") for d in ("dom0", "dom1")]
    found = batches.coverage(done, wanted)
    return found.select("cycle_date", F.array_join("source_systems", ",").alias("source_systems"), "is_complete")


@query
def overlapping_batches(spark, folder):
    history = _daily(spark, folder).where(F.col("cycle_date") < F.lit(HALF)).select(
        F.col("event_type").alias("source_system_name"), F.col("cycle_date").alias("cycledate"), F.col("batch_id").alias("batchid"))
    current = _tracking(spark, folder).select("source_system_name", "cycle_date", "batch_id").distinct()
    return batches.overlapping(current, history)


@query
def duplicate_runs(spark, folder):
    current = w.query(spark, folder, "select 'orders' as domain_name, o_orderpriority as source_system, 'DAILY' as batch_frequency, o_orderkey as batch_id, cast(o_orderdate as date) as cycle_date from orders")
    return batches.duplicate_runs(current)


@query
def calendar_flags(spark, folder):
    cycles = w.query(spark, folder, "select distinct cast(o_orderdate as date) as cycle_date, o_orderpriority as source_system_name from orders")
    month_ends = cycles.where(F.col("cycle_date") == F.last_day("cycle_date")).select(
        F.col("cycle_date").alias("monthend_date"), F.last_day(F.add_months("cycle_date", -1)).alias("prev_monthend_date"))
    week_ends = cycles.where(F.dayofweek("cycle_date") == 6).select(
        F.col("cycle_date").alias("weekend_date"), "source_system_name", F.date_sub("cycle_date", 7).alias("prev_weekend_date"))
    return batches.calendar_flags(cycles, month_ends, week_ends)


FEEDS = """select o_orderpriority as source_system, o_orderkey as batch_id, cast(o_orderdate as date) as effective_date,
 case when o_orderstatus = 'F' then 'MONTHLY' else 'DAILY' end as batch_description from orders"""


@query
def inforce_batch(spark, folder):
    return batches.inforce_batch(w.query(spark, folder, FEEDS), F.lit(date(1999, 3, 31)), previous_month=True)


@query
def second_daily_batch(spark, folder):
    return batches.nth_daily_batch(w.query(spark, folder, FEEDS), F.lit(date(1999, 3, 31)), 2)


@query
def rerun_state(spark, folder):
    table = _loaded_orders(spark, folder).withColumns({
        "original_cycle_date": F.date_sub("cycle_date", 3), "original_batch_id": F.lit(0)})
    return batches.rerun_state(
        table, _order_errors(spark, folder), F.lit(date(1998, 6, 15)), F.lit(1), ERROR_BATCH.table_name)


# Controls.

MEASURES = [
    controls.Measure(controls.TOTAL_COUNT),
    controls.Measure(controls.DISTINCT_COUNT, "l_partkey"),
    controls.Measure(controls.SUM_TOTAL, "l_extendedprice"),
    controls.Measure(controls.SUM_YEAR, "l_shipdate"),
    controls.Measure(controls.GROUPED_COUNT, "l_returnflag"),
    controls.Measure(controls.GROUPED_COUNT, "l_returnflag,l_linestatus"),
]
LOG_KEYS = ["operation", "control_id", "fact_col_name", "group_col_name", "group_col_val"]


@query
def kc2_measures(spark, folder):
    return controls.measure(w.table(spark, folder, "lineitem"), MEASURES, "S", "lines", "IDL").drop("hop_name", "domain")


@query
def kc2_by_batch(spark, folder):
    lines = w.table(spark, folder, "lineitem").withColumn("batch", F.year("l_shipdate"))
    return controls.measure(lines, MEASURES[:4], F.col("l_returnflag"), "lines", "working", by=("batch",)).drop("hop_name", "domain")


@query
def kc2_compare(spark, folder):
    lines = w.table(spark, folder, "lineitem")
    source = controls.measure(lines, MEASURES, "S", "lines", "IDL")
    target = controls.measure(lines.where("l_quantity > 1"), MEASURES, "T", "lines", "CURATED")
    return controls.key_results(source, target, LOG_KEYS)


@query
def catalogue_measures(spark, folder):
    catalogue = w.query(spark, folder, """select distinct 'lines' as domain_name, 'tpch' as source_system_name,
      case when r_regionkey = 0 then 'Total Count' when r_regionkey = 1 then 'DistinctCount'
           when r_regionkey = 2 then 'Sum Total' else 'Sum Total on Year' end as measure_type,
      case when r_regionkey = 0 then 'recordcount' when r_regionkey = 1 then 'l_suppkey'
           when r_regionkey = 2 then 'l_quantity' else 'l_shipdate' end as measure_field,
      case when r_regionkey = 4 then 'N' else 'Y' end as is_active from region""")
    measures = controls.from_catalogue(catalogue, "lines", "tpch")
    return controls.measure(w.table(spark, folder, "lineitem"), measures, "S", "lines", "working").select(
        "operation", "fact_col_name", "fact_val")


# Domains, systems and measures: every fifth combination is not active, and some name a field that rows do not have.
CATALOGUE = """select distinct case when a.n_regionkey < 3 then 'sales' else 'returns' end as domain_name, case when a.n_nationkey % 2 = 0 then 'F' else 'O' end as source_system_name,
 case b.n_nationkey % 5 when 0 then 'Total Count' when 1 then 'DistinctCount' when 2 then 'Sum Total' when 3 then 'Sum Total on Year' else 'Count grouped by distinct value' end as measure_type,
 case b.n_nationkey % 5 when 0 then 'recordcount' when 1 then case when b.n_regionkey < 2 then 'l_suppkey' else 'l_linenumber' end when 2 then case when b.n_regionkey < 3 then 'l_quantity' else 'l_tax' end
  when 3 then 'l_shipdate' else case when b.n_regionkey < 2 then 'l_linenumber' else 'l_returnflag' end end as measure_field,
 case when (a.n_regionkey + b.n_nationkey) % 5 = 0 then 'N' else 'Y' end as is_active from nation a join nation b on (a.n_nationkey + b.n_nationkey) % 3 = 0"""


@query
def catalogue_by_system(spark, folder):
    """Two domains with two systems each, measured in one pass by what the catalogue names for them."""
    lines = w.table(spark, folder, "lineitem").withColumns({
        "domain_name": F.when(F.col("l_returnflag") == "R", "returns").otherwise("sales"), "source_system_name": F.col("l_linestatus"), "year": F.year("l_shipdate")})
    fields = ["l_suppkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"]
    found = controls.measure_by_catalogue(lines, w.query(spark, folder, CATALOGUE), fields, "S", "staging", by=("year",))
    return found.drop("hop_name", "tag")


LINE_MEASURES = [controls.Measure(controls.TOTAL_COUNT), controls.Measure(controls.SUM_TOTAL, "default_amount", "ignore_negative"),
                 controls.Measure(controls.GROUPED_COUNT, "data_type")]


def _log(spark, folder) -> DataFrame:
    raw, lines = _raw(spark, folder), w.loaded_lines(spark, folder)
    rows = ex.line_rows(raw, w.LINE_BATCH.cycle_number)
    found = lookups.look_up(rows, *_known(spark, folder).in_force(w.LINE_BATCH))
    excluded = found.where(lookups.is_excluded("sblgdr_include_exclude", "ldgr_include_exclude"))
    headers = w.loaded_headers(spark, folder).final.select("transaction_number", "data_type")
    target = load.Outcome(lines.rows, lines.hard, lines.cleared, lines.soft, lines.final.join(headers, "transaction_number"))
    target_measures = [LINE_MEASURES[0], controls.Measure(controls.SUM_TOTAL, "default_amount"), LINE_MEASURES[2]]
    return load.load_log(rows, excluded, target, LINE_MEASURES, w.LINE_BATCH, target_measures)


@query
def balance_lines(spark, folder):
    return controls.balance(_log(spark, folder), LOG_KEYS)


@query
def balance_headers(spark, folder):
    """Header rows against distinct headers: the copies that ``distinct`` removes are adjustments too."""
    raw, headers = _raw(spark, folder), w.loaded_headers(spark, folder)
    rows = ex.header_rows(raw, w.HEADER_BATCH.cycle_number)
    found = lookups.look_up(rows, *_known(spark, folder).in_force(w.HEADER_BATCH))
    excluded = found.where(lookups.is_excluded("sblgdr_include_exclude", "ldgr_include_exclude"))
    measures = [controls.Measure(controls.TOTAL_COUNT), controls.Measure(controls.GROUPED_COUNT, "data_type")]
    log = load.load_log(rows, excluded, headers, measures, w.HEADER_BATCH)
    good = headers.rows.where(F.col("error_cleared").startswith("Good"))
    copies = controls.measure_copies(good, ["transaction_number_drvd", "data_type"], measures, w.HEADER_BATCH.domain, "curated")
    return controls.balance(log.unionByName(copies), LOG_KEYS)


@query
def control_log(spark, folder):
    """Measures of all batches as log rows: current batches and catalogued measures only."""
    lines = w.query(spark, folder, """select 'lines' as domain, 'tpch' as sys_nm, 'CONTROL_TOTAL' as measure_name, 'l_quantity' as measure_field,
      year(l_shipdate) as batch_id, cast(l_shipdate as date) as cycle_date, l_quantity from lineitem""")
    measured = lines.groupBy("domain", "sys_nm", "measure_name", "measure_field", "batch_id", "cycle_date").agg(
        F.sum("l_quantity").alias("measure_value"))
    current = w.query(spark, folder, "select distinct 'tpch' as source_system_name, year(o_orderdate) as batch_id, cast(o_orderdate as date) as cycle_date from orders where o_orderstatus = 'F'")
    catalogue = w.query(spark, folder, """select 'lines' as domain, 'tpch' as sys_nm, 'CONTROL_TOTAL' as measure_name,
      case when r_regionkey < 3 then 'l_quantity' else r_name end as measure_field, 'INTEGER' as measure_value_datatype from region""")
    return controls.log_entries(measured, current, catalogue)


@query
def adjustments(spark, folder):
    return controls.adjustments(_log(spark, folder), ["operation", "fact_col_name", "group_col_val"])


@query
def warehouse_balance(spark, folder):
    lines = w.table(spark, folder, "lineitem")
    tags = F.when(F.col("l_returnflag") == "A", "SA").when(F.col("l_returnflag") == "N", "SI").otherwise("TA")
    parts = [controls.measure(lines, MEASURES[:4], "S", "lines", "working"),
             controls.measure(lines, MEASURES[:4], "T", "lines", "working"),
             controls.measure(lines, MEASURES[:4], tags, "lines", "working")]
    return controls.warehouse_balance(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["operation", "fact_col_name"])


@query
def row_identity(spark, folder):
    return controls.row_identity(w.loaded_lines(spark, folder).rows)


@query
def control_totals(spark, folder):
    lines = w.table(spark, folder, "lineitem")
    dates = controls.control_total(lines, "l_shipdate", "DATE").withColumn("field", F.lit("l_shipdate"))
    return dates.unionByName(controls.control_total(lines, "l_orderkey").withColumn("field", F.lit("l_orderkey")))


@query
def additional_control(spark, folder):
    lines = w.table(spark, folder, "lineitem")
    return controls.additional_control(lines, lines.withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)), "l_quantity")


@query
def collapsed_copies(spark, folder):
    return controls.collapsed_copies(w.table(spark, folder, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"])


@query
def duplicates(spark, folder):
    lines = w.table(spark, folder, "lineitem")
    return controls.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query
def headers_without_lines(spark, folder):
    return controls.headers_without_lines(
        w.table(spark, folder, "orders").withColumnRenamed("o_orderkey", "k"),
        w.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "k"), ["k"])


@query
def header_count_check(spark, folder):
    return controls.header_count_check(
        w.table(spark, folder, "orders").withColumnRenamed("o_orderkey", "k"),
        w.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "k"), "k")


@query
def forced_good_rows(spark, folder):
    """Good lines whose application area and source also hold a date error."""
    rows = classify.derive_codes(ex.line_rows(_raw(spark, folder), w.LINE_BATCH.cycle_number)).withColumn("dated", classify.date_error())
    good = ~F.col("dated") & F.col("gl_source_code_drvd").isNotNull()
    pair = ["gl_application_area_code", "gl_source_code_drvd"]
    pairs = controls.forced_good_pairs(rows, good, F.col("dated"), pair)
    _, forced = controls.error_rows(rows, good, pairs, pair)
    return forced.groupBy(*pair).agg(F.count(F.lit(1)).alias("rows"))


# Reshaping and the rest.


@query
def eav_transpose(spark, folder):
    entries = w.query(spark, folder, """select cast(user_id as string) as naturalkey, cast(ts as date) as load_date,
      case when event_id % 2 = 0 then 'Amount' else 'LABEL' end as column_name,
      case event_type when 'view' then 'Override' when 'click' then 'transform' else 'source' end as transform_type,
      case when event_type = 'view' and event_id % 3 = 0 then '' else 'v' || cast(event_id % 1000 as string) end as cde_value from events""")
    return reshape.transposed(entries, ["naturalkey", "load_date"], ["amount", "label"], "column_name", "transform_type", "cde_value")


@query
def eav_record_count(spark, folder):
    events = w.table(spark, folder, "events").withColumn("load_date", F.col("ts").cast("date"))
    return reshape.entity_count(events, ["user_id", "event_type"], ["load_date"])


KV = """select o_orderkey, o_orderstatus, case when o_orderkey % 3 = 0 then '101-CONTRACT_NO' when o_orderkey % 3 = 1 then '45_CONTRACT_NO' end as gr1_name,
 'C' || cast(o_custkey as string) as gr1_value, case when o_orderkey % 2 = 0 then '102-OLD_CONTRACT_NO' else '103-OTHER' end as gr2_name,
 'X' || cast(o_custkey as string) as gr2_value from orders"""


@query
def pairs_to_columns(spark, folder):
    return reshape.pairs_to_columns(w.query(spark, folder, KV), ["o_orderkey"], ["contract_no", "45_contract_no"], "CONTRACT_NO").withColumn(
        "other_pairs", F.array_join(F.transform(F.array_sort(F.map_entries("other_pairs")), lambda p: F.concat(p["key"], F.lit("="), p["value"])), ","))


@query
def pivot_pairs(spark, folder):
    pairs = reshape.stacked_pairs(w.query(spark, folder, KV), ["o_orderkey"]).where(F.col("key").isNotNull())
    return reshape.pivot_pairs(pairs.withColumn("key", reshape.normal_key()), ["o_orderkey"])


@query
def header_line_join(spark, folder):
    headers = w.table(spark, folder, "orders").withColumnsRenamed({"o_orderkey": "transaction_number", "o_orderstatus": "status", "o_totalprice": "amount"})
    lines = w.table(spark, folder, "lineitem").withColumnsRenamed({"l_orderkey": "transaction_number", "l_linestatus": "status", "l_extendedprice": "amount"})
    return reshape.header_line_join(headers, lines, ["transaction_number"]).select(
        "transaction_number", "l_linenumber", "header_status", "line_status", "header_amount", "line_amount", "l_partkey", "l_shipdate")


@query
def combined_window(spark, folder):
    orders = w.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("cycle_date"))
    frames = {"open": orders.where("o_orderstatus = 'O'"), "partial": orders.where("o_orderstatus = 'P'").drop("o_orderpriority"),
              "finished": orders.where("o_orderstatus = 'F'").drop("o_orderstatus")}
    return ex.combined_window(frames, F.lit(date(1999, 3, 31)))


@query
def current_view(spark, folder):
    headers = w.loaded_headers(spark, folder).final.withColumnsRenamed({"cycle_date": "cycledate", "batch_id": "batchid"})
    view = tables.projection(headers, tables.HEADER_VIEW).drop("inserttimestamp", "updatetimestamp")
    return _text(view, "original_batch_id")


@query
def current_line_view(spark, folder):
    lines = w.loaded_lines(spark, folder).final.withColumnsRenamed({"cycle_date": "cycledate", "batch_id": "batchid"})
    view = tables.projection(lines, tables.LINE_VIEW).drop("inserttimestamp", "updatetimestamp", "activity_accounting_id")
    return _text(view, "original_batch_id")


TREE = """select 'world' as name, cast(null as string) as parent, 'World' as description_us, 'Y' as summary, 0 as allow_posting, 1 as cycle_date from region where r_regionkey = 0
 union all select 'r' || cast(r_regionkey as string), 'world', r_name, 'Y', 0, 1 from region
 union all select 'n' || cast(n_nationkey as string), 'r' || cast(n_regionkey as string), n_name, 'Y', 0, 1 from nation
 union all select 's' || cast(s_suppkey as string), 'n' || cast(s_nationkey as string), s_name, 'N', 1, 1 from supplier
 union all select 'c' || cast(c_custkey as string), 'n' || cast(c_nationkey as string), c_name, 'N', 1, 1 from customer
 union all select 'c' || cast(c_custkey as string), 'r' || cast(c_custkey % 5 as string), c_name, 'N', 1, 1 from customer where c_custkey % 9 = 0
 union all select 'k' || cast(p_partkey as string), case when p_partkey % 25 = 0 then 'n8' else 'k' || cast(p_partkey - 1 as string) end, 'Chain ' || cast(p_partkey as string), 'N', 1, 1
  from part"""


@query
def hierarchy_levels(spark, folder):
    return hierarchy.level_paths(w.query(spark, folder, TREE), ["summary", "allow_posting"])


@query
def leaves_below(spark, folder):
    return hierarchy.leaves_below(w.query(spark, folder, TREE), "ASIA").select("name", "parent", "description_us", "cycle_date")


@query
def row_hashes(spark, folder):
    orders = w.table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", identity.row_hash(["o_orderstatus", "o_orderpriority"]).alias("header_hash"),
        identity.row_hash(["o_custkey", "o_orderkey"]).alias("line_hash"))


PATTERNS = {
    "line code": identity.HashPattern(("1-URGENT", "2-HIGH")),
    "no code": identity.HashPattern(("3-MEDIUM",), "none"),
    "header code": identity.HashPattern(("4-NOT SPECIFIED", "5-LOW"), "header"),
}


@query
def pattern_hashes(spark, folder):
    """Lines of all systems hashed together, each by the columns of its system's pattern."""
    orders = w.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    rows = w.table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    hashed = identity.pattern_hashes(
        rows, "o_orderpriority", PATTERNS, ["o_orderkey", "o_custkey", "o_orderstatus"],
        ["l_linenumber", "l_returnflag", "l_linestatus", "l_partkey"], "l_linestatus", "o_orderstatus", ignored=["o_custkey"])
    return hashed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "header_hash", "line_hash")


@query
def document_ids(spark, folder):
    customers = w.table(spark, folder, "customer")
    return customers.select("c_custkey", identity.uuid3("c_name").alias("uuid3"), identity.uuid5("c_name").alias("uuid5"))


@query
def masked_names(spark, folder):
    key = F.lit("0123456789abcdef")
    masked = w.table(spark, folder, "customer").select("c_custkey", "c_name", identity.mask("c_name", key).alias("masked"))
    return masked.select("c_custkey", identity.unmask("masked", key).alias("c_name"), (F.col("masked") != F.col("c_name")).alias("is_masked"))


MONTHLY = """select o_orderkey, o_orderstatus as status, year(o_orderdate) * 100 + month(o_orderdate) as month from orders"""


def _new_table(spark, rows: DataFrame, partitions: list[str]) -> str:
    """A table of its own for one query, below the shared folder."""
    path = stage_path(spark, "table")
    name = "t_" + path.rsplit("-", 1)[-1]
    tables.create(spark, name, rows.schema, partitions, path)
    return name


@query
def written_partitions(spark, folder):
    """Append, replace the partitions that new rows name, clear one partition, read back."""
    rows = w.query(spark, folder, MONTHLY)
    name = _new_table(spark, rows, ["month"])
    tables.append(rows.where("status <> 'P'"), name)
    tables.append(rows.where("status = 'P'"), name)
    tables.overwrite_partitions(rows.where("month % 3 = 0").withColumn("status", F.lit("X")), name)
    tables.clear_partition(spark, name, {"month": 199505})
    tables.replace_partition(rows.where("month = 199606 and status = 'F'"), name, {"month": 199606})
    return spark.table(name)


@query
def truncated_and_loaded(spark, folder):
    rows = w.query(spark, folder, MONTHLY)
    name = _new_table(spark, rows, ["month"])
    tables.append(rows, name)
    tables.truncate_and_load(rows.where("status = 'F'"), name)
    return spark.table(name)


@query
def error_backup(spark, folder):
    errors_now = w.table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "headers").otherwise("lines").alias("table_name"),
        F.col("o_orderstatus").alias("reprocess_flag"))
    out = stage_path(spark, "backup")
    tables.back_up(tables.backup_rows(errors_now, "lines", "rerun", "O"), out)
    return spark.read.parquet(out)


@query
def reconciled_columns(spark, folder):
    """Headers with the line columns they lack, as null text."""
    orders, lines = w.table(spark, folder, "orders"), w.table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    of_header, of_line = reshape.schema_differences(orders, lines, derived=("o_orderdate",))
    whole = reshape.with_missing(orders, of_line, ignore=("l_tax", "l_discount"))
    return whole.select("o_orderkey", F.lit(",".join(sorted(of_header))).alias("of_header"), *sorted(set(whole.columns) - set(orders.columns)))


@query
def load_states(spark, folder):
    """What history holds of a load: before it, after it, and after a part of it."""
    first, staging = _first_half(spark, folder), _second_half(spark, folder)
    working = materialise(scd2.working_type2(staging, first), "working")
    loaded = materialise(scd2.apply_working(first, working), "loaded")
    part = loaded.where(F.col("user_id") % 2 == 0)
    held = [scd2.load_state(h, working) for h in (first, loaded, part)]
    sizes = [first.count(), loaded.count(), part.count()]
    return spark.range(1).select(F.explode(F.arrays_zip(F.lit(held).alias("state"), F.lit(sizes).alias("versions"))).alias("x")).select("x.*")


RUNS = """select distinct 'orders' as domain_name, o_orderstatus as source_system, 'DAILY' as batch_frequency,
 year(o_orderdate) * 100 + month(o_orderdate) as batch_id, year(o_orderdate) * 100 + month(o_orderdate) as cycle_date from orders"""


@query
def completed_batches(spark, folder):
    """Current batches whose day is complete already, and those that are not through."""
    runs = w.query(spark, folder, RUNS)
    done = runs.where("batch_id % 2 = 0")
    again = batches.already_completed(runs, done.where("batch_id % 4 = 0")).withColumn("kind", F.lit("completed"))
    open_ = batches.unfinished(runs, done).withColumn("kind", F.lit("unfinished"))
    return again.unionByName(open_).select("kind", "source_system", "batch_id")


@query
def incomplete_rows(spark, folder):
    outcome = F.when(F.col("o_orderstatus") == "F", "Good").when(F.col("o_orderstatus") == "O", "Soft Error").otherwise("Unknown outcome")
    rows = w.table(spark, folder, "orders").select(
        "o_orderkey", outcome.alias("error_cleared"), F.when(F.col("o_custkey") % 4 > 0, F.col("o_custkey")).alias("k"))
    return controls.incomplete_good_rows(rows, ["o_orderkey", "k"]).select("o_orderkey", "error_cleared")


@query
def repaired_markers(spark, folder):
    """Soft rows that an unfinished re-run left marked."""
    rows = w.table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "Soft/Rerun").otherwise("Soft").alias("error_classification_name"),
        F.col("o_orderpriority").alias("error_message"), F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N").alias("reprocess_flag"))
    return errors.repair_rerun_markers(rows, rerun=False)
