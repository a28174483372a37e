"""The life of a rejected row: recorded as JSON, retried, cleared, aged, reinstated."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillbook.operators.batch import Batch
from quillbook.session import control_table

ERROR_COLUMNS = [
    "recorded_timestamp",
    "original_recorded_timestamp",
    "original_cycle_date",
    "original_batch_id",
    "error_classification_name",
    "error_message",
    "error_record_aging_days",
    "error_record",
    "table_name",
    "reprocess_flag",
]
ERROR_SCHEMA = (
    "recorded_timestamp timestamp, original_recorded_timestamp timestamp, original_cycle_date date, "
    "original_batch_id int, error_classification_name string, error_message string, "
    "error_record_aging_days int, error_record string, table_name string, reprocess_flag string"
)

# Reprocess flags, classifications, and the default age limit.
SOFT, HARD, CLEARED = "Y", "N", "R"
AGED = "Hard/Aged Soft"
RERUN = "Soft/Rerun"
MAX_AGE_DAYS = 14

# Business and derived fields of the error JSON.
HEADER_FIELDS = """gl_application_area_code gl_source_code secondary_ledger_code transaction_date
gl_reversal_date gl_full_source_code orig_gl_center data_type""".split()
HEADER_DERIVED = """transaction_number_drvd source_system_nm_drvd ledger_name_drvd event_type_code_drvd
subledger_short_name_drvd transaction_date_drvd gl_reversal_date_drvd gl_source_code_drvd
secondary_ledger_code_drvd reinsuranceassumedcededflag_drvd""".split()
LINE_FIELDS = """gl_application_area_code gl_source_code secondary_ledger_code transaction_date
gl_reversal_date data_type default_amount debit_credit_indicator orig_gl_source_document_id
orig_gl_company orig_gl_account orig_gl_center gl_full_source_code orig_gl_description_1
orig_gl_description_2 orig_gl_description_3 orig_gl_project_code""".split()
LINE_DERIVED = """transaction_number source_system_nm_drvd ledger_name_drvd event_type_code_drvd
subledger_short_name_drvd transaction_date_drvd gl_reversal_date_drvd gl_source_code_drvd
secondary_ledger_code_drvd default_amount_drvd reinsuranceassumedcededflag_drvd
reinsurancetreatybasis_drvd reinsurancetreatynumber_drvd typeofbusinessreinsured_drvd
reinsurancegroupindividualflag_drvd reinsuranceaccountflag_drvd""".split()
CLEARED_LINE_DERIVED = ["activity_accounting_id", "line_number", *LINE_DERIVED]


def _record(fields: list[str], derived: list[str], extra: list[Column]) -> Column:
    nested = F.to_json(F.struct(*derived)).alias("drvd_data")
    return F.to_json(F.struct(*fields, nested, *extra))


def _error_rows(
    rows: DataFrame, batch: Batch, classification: str, flag: str, message: Column, aging: Column, record: Column
) -> DataFrame:
    first_seen = F.when(batch.originates(), batch.recorded()).otherwise(F.col("original_recorded_timestamp"))
    return rows.select(
        batch.recorded().alias("recorded_timestamp"),
        first_seen.cast("timestamp").alias("original_recorded_timestamp"),
        F.col("original_cycle_date").cast("date").alias("original_cycle_date"),
        F.col("original_batch_id").cast("int").alias("original_batch_id"),
        F.lit(classification).alias("error_classification_name"),
        message.cast("string").alias("error_message"),
        aging.cast("int").alias("error_record_aging_days"),
        record.alias("error_record"),
        F.lit(batch.table_name).alias("table_name"),
        F.lit(flag).alias("reprocess_flag"),
    )


def _aging(batch: Batch) -> Column:
    return F.datediff(batch.cycle(), F.col("original_cycle_date"))


def hard_errors(rows: DataFrame, batch: Batch, fields: list[str], derived: list[str]) -> DataFrame:
    bad = rows.where(F.length("hard_error_message") > 0)
    return _error_rows(
        bad, batch, "Hard", HARD, F.col("error_message"), _aging(batch), _record(fields, derived, []))


def soft_errors(rows: DataFrame, batch: Batch, fields: list[str], derived: list[str]) -> DataFrame:
    bad = rows.where((F.length("error_message") > 0) & (F.length("hard_error_message") == 0))
    return _error_rows(
        bad, batch, "Soft", SOFT, F.col("error_message"), _aging(batch), _record(fields, derived, []))


def cleared_errors(rows: DataFrame, batch: Batch, fields: list[str], derived: list[str]) -> DataFrame:
    """Rows of earlier batches that are valid now, stamped with this batch."""
    good = rows.where((F.length("error_message") == 0) & batch.precedes())
    stamp = [batch.cycle().alias("cycle_date"), batch.number().alias("batch_id"), F.col("old_error_message")]
    return _error_rows(
        good, batch, "Cleared", CLEARED, F.lit(None), F.lit(0), _record(fields, derived, stamp))


def explode_errors(errors: DataFrame, fields: list[str]) -> DataFrame:
    """JSON fields as text columns. Fields a record lacks are null, so no inference is needed."""
    schema = StructType([StructField(f, StringType()) for f in fields])
    plain = [c for c in errors.columns if c not in fields]
    return errors.withColumn("_json", F.from_json("error_record", schema)).select(*plain, "_json.*")


def error_schema(errors: DataFrame) -> str:
    """The schema all records of ``errors`` share, found in one aggregation."""
    found = errors.select(F.schema_of_variant_agg(F.parse_json("error_record")).alias("s")).first()["s"]
    return re.sub(r": VOID\b", ": STRING", found.replace("OBJECT<", "STRUCT<"))


def _of_table(errors: DataFrame, batch: Batch) -> DataFrame:
    known = F.col("original_cycle_date").isNotNull() & F.col("original_batch_id").isNotNull()
    return errors.where((F.col("table_name") == batch.table_name) & known)


def reprocessable(errors: DataFrame, batch: Batch) -> DataFrame:
    """Soft errors of earlier batches."""
    older = (F.col("original_cycle_date") < batch.cycle()) | (F.col("original_batch_id") < batch.number())
    return _of_table(errors, batch).where((F.col("reprocess_flag") == SOFT) & older)


def forced(errors: DataFrame, batch: Batch) -> DataFrame:
    """Hard errors of this cycle and soft ones that were forced."""
    hard = (F.col("reprocess_flag") == HARD) & (F.col("original_cycle_date") == batch.cycle())
    soft = (F.col("reprocess_flag") == SOFT) & F.col("error_message").startswith("XForced Error")
    return _of_table(errors, batch).where(hard | soft)


def of_batch(errors: DataFrame, batch: Batch) -> DataFrame:
    """Soft and hard errors that arrived in this batch."""
    return _of_table(errors, batch).where(F.col("reprocess_flag").isin(SOFT, HARD) & batch.originates())


def _stamped(batch: Batch) -> Column:
    """True for records that carry this batch as the one that changed them."""
    cycle = F.get_json_object("error_record", "$.cycle_date")
    number = F.get_json_object("error_record", "$.batch_id")
    same = (cycle == F.lit(batch.cycle_date.isoformat())) & (number == F.lit(str(batch.batch_id)))
    return F.coalesce(same, F.lit(False))


def _without(record: str, names: list[str], schema: str) -> Column:
    return F.to_json(F.from_json(record, schema).dropFields(*names)) if names else F.col(record)


def _require(condition: bool, text: str) -> None:
    if not condition:
        raise ValueError(text)


def repair_rerun_markers(errors: DataFrame, rerun: bool) -> DataFrame:
    """Soft rows left as ``Soft/Rerun`` by an unfinished re-run become cleared again."""
    marked = (F.col("reprocess_flag") == SOFT) & (F.col("error_classification_name") == RERUN)
    if rerun:
        _require(errors.where(marked).isEmpty(), "a re-run has already reinstated soft errors")
        return errors
    return errors.withColumns({
        "error_classification_name": F.when(marked, "Cleared").otherwise(F.col("error_classification_name")),
        "error_message": F.when(marked, None).otherwise(F.col("error_message")),
        "reprocess_flag": F.when(marked, CLEARED).otherwise(F.col("reprocess_flag")),
    })


def reinstate_processed(errors: DataFrame, batch: Batch, schema: str) -> DataFrame:
    """Soft and cleared rows as they were before this batch cleared some of them."""
    own = F.col("table_name") == batch.table_name
    undo = own & (F.col("reprocess_flag") == CLEARED) & _stamped(batch)
    stamp = [n for n in ("cycle_date", "batch_id", "old_error_message") if f"{n}:" in schema]
    back = errors.where(undo).withColumns({
        "recorded_timestamp": batch.recorded(),
        "error_classification_name": F.lit(RERUN),
        "error_message": F.get_json_object("error_record", "$.old_error_message"),
        "error_record_aging_days": _aging(batch),
        "error_record": _without("error_record", stamp, schema),
        "reprocess_flag": F.lit(SOFT),
    })
    kept = errors.where(own & F.col("reprocess_flag").isin(SOFT, CLEARED) & ~undo)
    return kept.select(*ERROR_COLUMNS).unionByName(back.select(*ERROR_COLUMNS))


def reinstate_errors(errors: DataFrame, batch: Batch, flag: str, schema: str, rerun: bool) -> DataFrame:
    """Rows of one flag without those of an earlier run of this batch.

    Soft errors that this batch had turned into aged hard ones are soft again.
    Refused unless ``rerun`` when that touches rows of other batches.
    """
    rows = _of_table(errors, batch).where(F.col("reprocess_flag") == flag)
    aged = (F.col("error_classification_name") == AGED) & _stamped(batch) & F.lit(flag == HARD)
    if not rerun:
        seen = rows.agg(
            F.count_if(batch.originates() & ~aged).alias("own"),
            F.count_if(~batch.originates() & ~aged).alias("older"),
            F.count_if(aged).alias("aged"),
        ).first()
        _require(not (seen["own"] and (seen["older"] or seen["aged"])),
                 f"re-run not allowed: {seen['own']} errors of this batch beside {seen['older']} older ones "
                 f"and {seen['aged']} aged ones")
    stamp = [n for n in ("cycle_date", "batch_id") if f"{n}:" in schema]
    back = rows.where(aged).withColumns({
        "error_record": _without("error_record", stamp, schema),
        "error_classification_name": F.lit("Soft"),
        "reprocess_flag": F.lit(SOFT),
    })
    kept = rows.where(~aged & ~batch.originates())
    return kept.select(*ERROR_COLUMNS).unionByName(back.select(*ERROR_COLUMNS))


def age_soft_errors(errors: DataFrame, batch: Batch, schema: str, max_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Soft errors older than the limit become hard, stamped with this batch."""
    soft = errors.where((F.col("reprocess_flag") == SOFT) & (F.col("table_name") == batch.table_name))
    old = F.col("error_record_aging_days") > max_days
    stamped = F.from_json("error_record", schema).withField(
        "cycle_date", F.lit(batch.cycle_date.isoformat())).withField("batch_id", batch.number())
    return soft.withColumns({
        "recorded_timestamp": F.when(old, batch.recorded()).otherwise(F.col("recorded_timestamp")),
        "error_classification_name": F.when(old, AGED).otherwise(F.col("error_classification_name")),
        "error_record": F.when(old, F.to_json(stamped)).otherwise(F.col("error_record")),
        "reprocess_flag": F.when(old, HARD).otherwise(F.col("reprocess_flag")),
    }).select(*ERROR_COLUMNS)


def check_aged_pair(headers: DataFrame, lines: DataFrame, max_days: int = MAX_AGE_DAYS) -> None:
    """Aged soft errors must exist for headers and lines, or for neither."""
    def any_aged(df: DataFrame) -> bool:
        return not df.where((F.col("reprocess_flag") == SOFT) & (F.col("error_record_aging_days") > max_days)).isEmpty()

    header, line = any_aged(headers), any_aged(lines)
    _require(header == line, f"aged soft errors for headers: {header}, for lines: {line}")


def aged_pairs(errors: DataFrame, cycle: Column, max_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Soft errors too old at ``cycle``, counted for headers and lines of each source system in one pass.

    A system is consistent if both have some or neither has.
    """
    old = (F.col("reprocess_flag") == SOFT) & (F.datediff(cycle, "original_cycle_date") > max_days)
    system = F.split_part("table_name", F.lit("_"), F.lit(1))
    return errors.groupBy(system.alias("source_system_name")).agg(
        F.count_if(old & F.endswith("table_name", F.lit("_header"))).alias("aged_headers"),
        F.count_if(old & F.endswith("table_name", F.lit("_line_item"))).alias("aged_lines"),
    ).withColumn("consistent", (F.col("aged_headers") > 0) == (F.col("aged_lines") > 0))


def require_aged_pairs(errors: DataFrame, cycle: Column, max_days: int = MAX_AGE_DAYS) -> None:
    """Refuse to age one side of a source system whose other side has nothing to age."""
    # A row per source system.
    apart = aged_pairs(errors, cycle, max_days).where(~F.col("consistent")).orderBy("source_system_name").collect()
    _require(not apart, "aged soft errors on one side only: " + ", ".join(
        f"{r['source_system_name']} {r['aged_headers']} headers, {r['aged_lines']} lines" for r in apart))


# Edits of a single JSON field.


def _has_field(schema: str, name: str) -> bool:
    return name in StructType.fromDDL(re.sub(r"^STRUCT<(.*)>$", r"\1", schema)).fieldNames()


def add_field(errors: DataFrame, name: str, value: Column, schema: str, overwrite: bool = True) -> DataFrame:
    if _has_field(schema, name) and not overwrite:
        return errors
    return errors.withColumn("error_record", F.to_json(F.from_json("error_record", schema).withField(name, value)))


def rename_fields(errors: DataFrame, names: dict[str, str], schema: str, skip_missing: bool = True) -> DataFrame:
    present = {old: new for old, new in names.items() if _has_field(schema, old)}
    _require(skip_missing or len(present) == len(names), f"fields not found: {sorted(set(names) - set(present))}")
    parsed = F.from_json("error_record", schema)
    renamed = reduce(lambda s, old: s.withField(present[old], parsed[old]), present, parsed)
    return errors.withColumn("error_record", F.to_json(renamed.dropFields(*present))) if present else errors


def update_field(
    errors: DataFrame, name: str, expression: str, schema: str, add_missing: bool = False
) -> DataFrame:
    """Set a field to a SQL expression over ``parsed_json`` and the row."""
    if not _has_field(schema, name) and not add_missing:
        return errors
    parsed = errors.withColumn("parsed_json", F.from_json("error_record", schema))
    if not _has_field(schema, name):
        parsed = parsed.withColumn("parsed_json", F.col("parsed_json").withField(name, F.lit(None).cast("string")))
    edited = F.to_json(F.col("parsed_json").withField(name, F.expr(expression)))
    return parsed.withColumn("error_record", edited).drop("parsed_json")


# Reports.


def error_view(errors: DataFrame, like: str, fields: list[str]) -> DataFrame:
    """Open errors of a kind of table with fields of their records as text columns, and the record as a variant.

    Records are parsed once and need no common schema. A field that a record
    lacks is null, and so are all fields of a text that is no JSON.
    """
    rows = errors.where(F.col("reprocess_flag").isin(SOFT, HARD) & F.col("table_name").like(like))

    # All fields are taken at once: each call of its own would copy the whole record.
    wanted = StructType([StructField(f, StringType()) for f in dict.fromkeys(fields)]).simpleString()
    parsed = rows.withColumn("_record", F.try_parse_json("error_record"))
    if fields:
        parsed = parsed.withColumn("_fields", F.try_variant_get("_record", "$", wanted))
    return parsed.select(
        "recorded_timestamp", "original_cycle_date", "original_batch_id", "original_recorded_timestamp",
        F.split_part("table_name", F.lit("_"), F.lit(1)).alias("source_system_name"),
        "table_name", "error_classification_name", "error_message", "error_record_aging_days", "reprocess_flag",
        *[F.col("_fields")[f].alias(f) for f in fields], F.col("_record").alias("error_record"),
    )


def error_type() -> Column:
    kind, message = F.col("error_classification_name"), F.col("error_message")

    def says(*texts: str) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(message, F.lit(t)) for t in texts])

    return (
        F.when((kind == "Soft") & says("Forced Error (Soft)"), "Forced Soft Error - RDM Lookup Missing")
        .when(kind == "Soft", "RDM Lookup Missing")
        .when((kind == "Hard") & says("Forced Error. Date Errors"), "Forced Hard Error - Date Invalid Format")
        .when((kind == "Hard") & says("Forced Error. Hard Errors"),
              "Forced Hard Error - Date Invalid Format or Data Invalid from Source")
        .when((kind == "Hard") & says("date", "Header Errored for Date Validation"), "Date Invalid Format")
        .otherwise("Data Invalid from Source")
    )


def error_details(
    errors: DataFrame, batches: DataFrame, source_system: str | None = None, domain: str | None = None, frequency: str | None = None,
    table_names: list[str] | None = None,
) -> DataFrame:
    """Open errors counted by origin, class, type and message, for the days that have a batch.

    A report is on the batches of one source system, domain and frequency, and
    on the error tables that belong to them; each day counts once.
    """
    wanted = {"source_system": source_system, "domain_name": domain, "batch_frequency": frequency}
    for name, value in wanted.items():
        batches = batches if value is None else batches.where(F.col(name) == value)
    open_errors = errors.where(F.col("reprocess_flag").isin(SOFT, HARD) & F.col("original_batch_id").isNotNull())
    if table_names is not None:
        open_errors = open_errors.where(F.col("table_name").isin(table_names))
    known = control_table(batches.select(F.col("cycle_date").alias("original_cycle_date"), "source_system"))
    return open_errors.join(known, "original_cycle_date").withColumn("error_type", error_type()).groupBy(
        "table_name", "original_cycle_date", "original_batch_id", "error_classification_name", "error_type",
        "error_message", "source_system",
    ).agg(F.count(F.lit(1)).alias("error_record_count"))


def error_summary(details: DataFrame) -> DataFrame:
    return details.groupBy(
        "table_name", "original_cycle_date", "original_batch_id", "error_classification_name", "error_type",
        "source_system",
    ).agg(F.sum("error_record_count").alias("error_record_count"))


def report_order(summary: DataFrame) -> DataFrame:
    return summary.orderBy(
        F.asc("table_name"), F.desc("original_cycle_date"), F.desc("original_batch_id"),
        F.asc("error_classification_name"), F.desc("error_type"))


def missing_references(details: DataFrame, number: str = "transaction_number") -> DataFrame:
    """Lookup keys that soft header errors wait for."""
    text = F.regexp_replace("error_message", f"(?i){number} is invalid;", "")
    soft = (F.col("error_classification_name") == "Soft") & F.col("table_name").like("%\\_header%")
    return details.where(soft).groupBy(text.alias("soft_error_message"), "original_cycle_date").agg(
        F.sum("error_record_count").alias("error_record_count"))


def reprocessed_summary(headers: DataFrame, lines: DataFrame, by: list[str]) -> DataFrame:
    """Headers and lines loaded from errors of earlier batches, by origin."""
    key = ["cycle_date", "batch_id", "original_cycle_date", "original_batch_id", "transaction_number"]
    again = headers.where(F.col("original_cycle_date").isNotNull() | F.col("original_batch_id").isNotNull())
    counted = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("_lines"))
    return again.join(counted, key, "left").groupBy(*key[:4], *by).agg(
        F.countDistinct("transaction_number").alias("header_count"),
        # A header without lines still counts as one row, as in a left join.
        F.sum(F.coalesce("_lines", F.lit(1))).alias("line_count"),
    )


def forced_counts(errors: DataFrame) -> DataFrame:
    """Forced errors by cause."""
    def like(text: str) -> Column:
        return F.count_if(F.col("error_message").startswith(text))

    return errors.agg(
        like("XForced Error (Soft).").alias("forced_soft_rdm"),
        like("XForced Error. Date Errors").alias("forced_hard_date"),
        like("XForced Error. Hard Errors").alias("forced_hard_data"),
        like("XForced Error").alias("total_forced"),
    )


def view_stats(view: DataFrame) -> DataFrame:
    return view.groupBy("original_cycle_date", "error_classification_name", "source_system_name").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("recorded_timestamp").alias("min_recorded_timestamp"),
        F.max("recorded_timestamp").alias("max_recorded_timestamp"),
        F.min("original_cycle_date").alias("min_original_cycle_date"),
        F.max("original_cycle_date").alias("max_original_cycle_date"),
    )
