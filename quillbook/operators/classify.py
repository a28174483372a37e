"""Classify ledger headers and lines as good, soft error or hard error."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbook.functions import codes, compact, groups, identity, rules
from quillbook.operators.batch import Batch
from quillbook.operators.lookups import is_included, look_up
from quillbook.session import control_table, materialise

# The columns that make up one header.
GRAIN = [
    "ledger_name_drvd",
    "source_system_nm_drvd",
    "event_type_code_drvd",
    "subledger_short_name_drvd",
    "gl_source_code_drvd",
    "gl_application_area_code",
    "transaction_date_drvd",
    "data_type",
    "gl_reversal_date_drvd",
    "secondary_ledger_code_drvd",
    "original_cycle_date",
    "original_batch_id",
]
OPTIONAL_GRAIN = "gl_reversal_date_drvd"
KEY = "_header_key"

HEADER_CONTENT = [
    "transaction_date",
    "gl_reversal_date",
    "gl_application_area_code",
    "gl_source_code",
    "secondary_ledger_code",
    "orig_gl_center",
    "data_type",
]

# The columns that order the lines of a transaction.
LINE_ORDER = [
    "default_amount",
    "debit_credit_indicator",
    "gl_full_source_code",
    "orig_gl_source_document_id",
    "orig_gl_company",
    "orig_gl_account",
    "orig_gl_center",
    "orig_gl_description_1",
    "orig_gl_description_2",
    "orig_gl_description_3",
    "orig_gl_project_code",
]

# Line attribute -> column of the reinsurance lookup.
REINSURANCE = {
    "reinsuranceassumedcededflag": "reinsurance_assumed_ceded_flag",
    "reinsurancetreatybasis": "reinsurance_basis",
    "reinsurancetreatynumber": "treaty_name",
    "typeofbusinessreinsured": "type_of_business_reinsured",
    "reinsurancegroupindividualflag": "reinsurance_group_individual_flag",
    "reinsuranceaccountflag": "reinsurance_account_flag",
}

# The texts of errors that are passed on to other rows.
FORCED_DATE = "Forced Error. Date Errors Present in Other Headers for combination of gl_application_area_code ("
FORCED_LOOKUP = "XForced Error. Hard Errors - Missing RDM Lookup for transaction_number "


def _text(c: str | Column, default: str = "") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def _when(condition: Column, *parts: str | Column) -> Column:
    """A message part, '' where its condition does not hold (or is null)."""
    message = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.when(condition, message).otherwise(F.lit(""))


def messages(*parts: Column) -> Column:
    return F.trim(F.concat(*parts))


def in_batch(rows: DataFrame, batch: Batch) -> DataFrame:
    """New rows, stamped with the batch they arrive in."""
    return rows.withColumns({
        "original_recorded_timestamp": batch.recorded(),
        "original_cycle_date": batch.cycle(),
        "original_batch_id": batch.number(),
        "old_error_message": F.lit(None).cast("string"),
        "error_record_aging_days": F.lit(None).cast("int"),
    })


def with_carried(rows: DataFrame, errors: DataFrame | None) -> DataFrame:
    """New rows and the soft errors of earlier batches, to be tried again."""
    if errors is None:
        return rows
    carried = errors.withColumnRenamed("error_message", "old_error_message")
    return rows.unionByName(carried.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema.fields]))


def derive_codes(rows: DataFrame) -> DataFrame:
    """Codes and dates read off the raw texts; whether a date is one is read off the date."""
    derived = rows.withColumns({
        "gl_source_code_drvd": codes.source_prefix("gl_source_code"),
        "secondary_ledger_code_drvd": codes.ledger_suffix("secondary_ledger_code"),
        "transaction_date_drvd": codes.julian_date("transaction_date"),
        "gl_reversal_date_drvd": codes.julian_date("gl_reversal_date"),
    })
    return derived.withColumns({
        "transaction_date_chk": F.col("transaction_date_drvd").isNotNull(),
        "gl_reversal_date_chk": codes.is_blank_or_zero("gl_reversal_date") | F.col("gl_reversal_date_drvd").isNotNull(),
    })


def _number(text: str) -> Column:
    return F.coalesce(codes.number(text, "int"), F.lit(0))


def reversed_early() -> Column:
    return (_number("gl_reversal_date") > 0) & (_number("transaction_date") > _number("gl_reversal_date"))


def date_error() -> Column:
    return ~F.col("transaction_date_chk") | ~F.col("gl_reversal_date_chk") | reversed_early()


def area_error() -> Column:
    return F.coalesce(F.length("gl_application_area_code"), F.lit(0)) == 0


def source_error() -> Column:
    return F.col("gl_source_code_drvd").isNull()


def ledger_error() -> Column:
    code = F.col("secondary_ledger_code")
    tail = F.substring(code, 3, 2)
    return F.coalesce((F.length(code) < 4) | F.contains(tail, F.lit(" ")), F.lit(True))


def field_messages(wording: str) -> list[Column]:
    """Messages for codes that are blank or malformed at the source."""
    def part(condition: Column, column: str, blank: str) -> Column:
        return _when(condition, _text(column, blank), f" {column} {wording}")

    blank = "BLANK/NULL" if "Invalid" in wording else "blank/null"
    return [
        part(area_error(), "gl_application_area_code", blank),
        part(source_error(), "gl_source_code", blank),
        part(ledger_error(), "secondary_ledger_code", blank),
    ]


def date_messages() -> list[Column]:
    def shown(raw: str, derived: str) -> Column:
        return F.when(F.col(derived).isNotNull(), F.col(raw)).otherwise(F.lit("null"))

    return [
        _when(~F.col("transaction_date_chk"), _text("transaction_date"),
              " transaction_date is in invalid format, expected yyyyjjj;"),
        _when(~F.col("gl_reversal_date_chk"), _text("gl_reversal_date"),
              " gl_reversal_date is in invalid format, expected yyyyjjj;"),
        _when(reversed_early(),
              shown("transaction_date", "transaction_date_drvd"), " > ",
              shown("gl_reversal_date", "gl_reversal_date_drvd"),
              " transaction_date is greater than gl_reversal_date;"),
    ]


def label(batch: Batch) -> Column:
    """Outcome of a row."""
    known = F.col("original_cycle_date").isNotNull() & F.col("original_batch_id").isNotNull()
    clean = F.length("error_message") == 0
    return (
        F.when(known & clean & ~batch.originates(), "Good - Reprocessed Error")
        .when(known & (F.length("hard_error_message") > 0), "Hard Error")
        .when(known & (F.length("soft_error_message") > 0), "Soft Error")
        .when(known & clean, "Good")
        .otherwise("Unknown")
    )


def _outcome(rows: DataFrame, batch: Batch) -> DataFrame:
    hard, soft = F.col("hard_error_message"), F.col("soft_error_message")
    rows = rows.withColumns({
        "error_message": F.trim(F.concat(hard, soft)),
        "reprocess_flag": F.when(F.length(hard) > 0, "N").when(F.length(soft) > 0, "Y"),
    })
    return rows.withColumn("error_cleared", label(batch))


def _complete() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in GRAIN if c != OPTIONAL_GRAIN])


def _with_key(rows: DataFrame, spread: Column) -> DataFrame:
    return rows.withColumn(KEY, identity.header_key(GRAIN, _complete(), spread))


def prepare_headers(
    rows: DataFrame, subledgers: DataFrame, ledgers: DataFrame, reinsurance: DataFrame
) -> DataFrame:
    """Header rows with lookups and derived codes; excluded rows leave here."""
    attributes = reinsurance.select("legal_entity", "center_code", "reinsurance_assumed_ceded_flag")
    found = look_up(rows, subledgers, ledgers, attributes.distinct())
    found = found.where(is_included("sblgdr_include_exclude", "ldgr_include_exclude"))
    flag = codes.reinsurance("gl_full_source_code", "reinsurance_assumed_ceded_flag")
    return derive_codes(found.withColumn("reinsuranceassumedcededflag_drvd", flag)).drop(
        "reinsurance_assumed_ceded_flag")


def header_groups(prepared: DataFrame) -> DataFrame:
    """One row per header candidate with what its rows say together.

    A group is bad as soon as one member lacks its reinsurance flag. This
    aggregate replaces a window over the group, so that a group of any size is
    reduced before it is shuffled; the valid header keys and the pairs with
    date errors are read off the same result.
    """
    row_ok = ~date_error() & ~area_error()
    grouped = prepared.groupBy(*GRAIN).agg(
        F.max(F.when(F.col("reinsuranceassumedcededflag_drvd") == codes.MISSING, 1).otherwise(0)).alias("_bad"),
        F.bool_or(row_ok).alias("_ok"),
        F.bool_or(date_error()).alias("_date_error"),
    )
    return grouped.withColumn("_valid", _complete() & F.col("_ok") & (F.col("_bad") == 0)).drop("_bad", "_ok")


def number_headers(grouped: DataFrame, batch: Batch) -> DataFrame:
    """Transaction numbers: event prefix, run time, sequence within the prefix.

    There are few prefixes, so each is a large group of its own.
    """
    valid = grouped.where("_valid").select(*GRAIN).withColumn("_event", F.substring("event_type_code_drvd", 1, 6))
    large = groups.find_large(valid, ["_event"], within=[grouped])
    numbered = groups.number_rows(valid, ["_event"], GRAIN, "_sequence", large)
    run = batch.run_ts.strftime("%Y%m%d%H%M%S") + f"{batch.run_ts.microsecond // 1000:03d}"
    number = F.concat(F.col("_event"), F.lit(run + "_"), F.col("_sequence").cast("string"))
    return _with_key(numbered, F.lit("")).select(KEY, number.alias("transaction_number_drvd"))


def forced_pairs(grouped: DataFrame, batch: Batch) -> DataFrame:
    """Application area and source of this batch with both a date error and a good header."""
    return (
        grouped.where(batch.originates())
        .groupBy("gl_application_area_code", "gl_source_code_drvd")
        .agg(F.bool_or("_date_error").alias("_errors"), F.bool_or("_valid").alias("_goods"))
        .where(F.col("_errors") & F.col("_goods"))
        .select(
            F.col("gl_application_area_code").alias("_f_area"),
            F.col("gl_source_code_drvd").alias("_f_source"),
            F.lit(True).alias("_forced"),
        )
    )


def _with_forced(rows: DataFrame, pairs: DataFrame, batch: Batch) -> DataFrame:
    return rows.join(
        pairs,
        (rows["gl_application_area_code"] == pairs["_f_area"])
        & (rows["gl_source_code_drvd"] == pairs["_f_source"])
        & batch.originates(),
        "left",
    ).drop("_f_area", "_f_source")


def _forced_message(source: str) -> Column:
    return _when(
        F.col("_forced") & F.col("_forceable"),
        FORCED_DATE, _text("gl_application_area_code"), ") and gl_source_code (", _text(source), ");")


@dataclass(frozen=True)
class LookupNames:
    """What messages call the lookups."""

    subledgers: str = "subledger_names"
    ledgers: str = "ledger_names"
    reinsurance: str = "reinsurance_attributes"


def classify_headers(prepared: DataFrame, batch: Batch, names: LookupNames = LookupNames()) -> DataFrame:
    """Messages, transaction number and outcome of every header row.

    The rows are read twice, for their groups and for themselves, so they are
    written first: they are the distinct headers, far fewer than the lines.
    """
    prepared = materialise(prepared, "prepared-headers")
    grouped = materialise(header_groups(prepared), "header-groups")
    keys = number_headers(grouped, batch)
    # Header rows are distinct, so their content spreads the incomplete ones.
    rows = _with_key(prepared, F.xxhash64(*HEADER_CONTENT)).join(keys, KEY, "left").drop(KEY)
    rows = _with_forced(rows, control_table(forced_pairs(grouped, batch)), batch)

    rows = rows.withColumn("_hard", messages(*date_messages(), *field_messages("is invalid from source;")))
    clean = F.length("_hard") == 0
    prefix = _text(F.substring("gl_source_code", 1, 3))

    def missing(what: str, table: str, *pairs: str | Column) -> list[str | Column]:
        return [f"{what} is missing in rdm table {table} for key combination ", *pairs, ");"]

    subledger_key = ["gl_application_area_code (", _text("gl_application_area_code"), ") and gl_source_code (", prefix]
    soft = messages(
        _when(clean & (F.col("source_system_nm_drvd").isNull() | F.col("event_type_code_drvd").isNull()),
              *missing("source_system_nm/event_type_code", names.subledgers, *subledger_key)),
        _when(clean & F.col("ledger_name_drvd").isNull(),
              *missing("ledger_name", names.ledgers,
                       "actvty_gl_ldgr_cd/secondary_ledger_code_drvd (",
                       _text(F.substring("secondary_ledger_code", 3, 2)),
                       ") and secondary_ledger_code (", _text("secondary_ledger_code"))),
        _when(clean & F.col("subledger_short_name_drvd").isNull(),
              *missing("subledger_short_name", names.subledgers, *subledger_key)),
        _when(clean & F.col("transaction_number_drvd").isNull(), "transaction_number is invalid;"),
        _when(clean & (F.col("reinsuranceassumedcededflag_drvd") == codes.MISSING),
              *missing("reinsuranceassumedcededflag", names.reinsurance,
                       "secondary_ledger_code (", _text(F.substring("secondary_ledger_code", 1, 2)),
                       ") and orig_gl_center (", _text("orig_gl_center"))),
    )
    rows = rows.withColumns({"soft_error_message": soft, "_forceable": clean})
    rows = rows.withColumn(
        "hard_error_message", messages(_forced_message("gl_source_code_drvd"), F.col("_hard")))
    return _outcome(rows.drop("_hard", "_forced", "_forceable"), batch)


def force_transactions(rows: DataFrame, batch: Batch, number: str) -> DataFrame:
    """Turn every other row of a transaction with a lookup error into a hard error.

    Rows without a number count as one transaction per batch. The transactions
    concerned are found by an aggregate and joined back, so a transaction of
    any size stays spread over its tasks.
    """
    key = ["original_cycle_date", "original_batch_id", number]
    own = F.contains(F.upper("error_message"), F.lit("RDM"))
    concerned = control_table(rows.where(own).select(
        *[F.col(c).alias(f"_t_{c}") for c in key], F.lit(True).alias("_concerned")))
    on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(concerned[f"_t_{c}"]) for c in key])
    joined = rows.join(concerned, on, "left").drop(*[f"_t_{c}" for c in key])
    forced = F.coalesce(F.col("_concerned") & ~own, F.lit(False))
    text = F.concat(F.lit(FORCED_LOOKUP), _text(number, "UNKNOWN"), F.lit(";"))

    def put_first(c: str) -> Column:
        return F.when(forced, F.concat(text, F.col(c))).otherwise(F.col(c))

    return joined.withColumns({
        "hard_error_message": put_first("hard_error_message"),
        "soft_error_message": put_first("soft_error_message"),
        "error_message": put_first("error_message"),
        "reprocess_flag": F.when(forced, "N").otherwise(F.col("reprocess_flag")),
        "error_cleared": F.when(forced, "Hard Error").otherwise(F.col("error_cleared")),
    }).drop("_concerned")


def final_headers(rows: DataFrame, batch: Batch) -> DataFrame:
    """Good headers in table form; reprocessed ones keep where they came from."""
    reprocessed = F.col("error_cleared") == "Good - Reprocessed Error"
    names = {
        "transaction_number": "transaction_number_drvd",
        "source_system_nm": "source_system_nm_drvd",
        "ledger_name": "ledger_name_drvd",
        "event_type_code": "event_type_code_drvd",
        "subledger_short_name": "subledger_short_name_drvd",
        "transaction_date": "transaction_date_drvd",
        "gl_reversal_date": "gl_reversal_date_drvd",
        "gl_application_area_code": "gl_application_area_code",
        "gl_source_code": "gl_source_code_drvd",
        "secondary_ledger_code": "secondary_ledger_code_drvd",
        "data_type": "data_type",
    }
    return rows.where(F.col("error_cleared").startswith("Good")).select(
        batch.recorded().alias("recorded_timestamp"),
        F.lit(batch.source_system).alias("source_system_name"),
        F.when(reprocessed, F.col("original_cycle_date")).alias("original_cycle_date"),
        F.when(reprocessed, F.col("original_batch_id")).alias("original_batch_id"),
        *[F.col(c).alias(n) for n, c in names.items()],
        batch.cycle().alias("cycle_date"),
        batch.number().alias("batch_id"),
    ).distinct()


def run_headers(headers: DataFrame, batch: Batch) -> DataFrame:
    """The headers loaded in this batch, keyed as their lines are."""
    own = headers.where((F.col("cycle_date") == batch.cycle()) & (F.col("batch_id") == batch.number()))
    names = {
        "ledger_name_drvd": "ledger_name",
        "source_system_nm_drvd": "source_system_nm",
        "event_type_code_drvd": "event_type_code",
        "subledger_short_name_drvd": "subledger_short_name",
        "gl_source_code_drvd": "gl_source_code",
        "gl_application_area_code": "gl_application_area_code",
        "transaction_date_drvd": "transaction_date",
        "data_type": "data_type",
        "gl_reversal_date_drvd": "gl_reversal_date",
        "secondary_ledger_code_drvd": "secondary_ledger_code",
    }
    keyed = own.select(
        *[F.col(c).alias(n) for n, c in names.items()],
        F.coalesce("original_cycle_date", "cycle_date").alias("original_cycle_date"),
        F.coalesce("original_batch_id", "batch_id").alias("original_batch_id"),
        "transaction_number",
    )
    return _with_key(keyed, F.lit("")).select(KEY, "transaction_number")


def forced_header_pairs(header_rows: DataFrame, batch: Batch) -> DataFrame:
    """Pairs whose headers were forced into error in this batch."""
    return (
        header_rows.where(batch.originates() & F.contains("hard_error_message", F.lit(FORCED_DATE)))
        .select(
            F.col("gl_application_area_code").alias("_f_area"), F.col("gl_source_code_drvd").alias("_f_source"))
        .withColumn("_forced", F.lit(True))
    )


def prepare_lines(
    rows: DataFrame, subledgers: DataFrame, ledgers: DataFrame, reinsurance: DataFrame
) -> DataFrame:
    found = look_up(rows, subledgers, ledgers, reinsurance)
    flags = ["sblgdr_include_exclude", "ldgr_include_exclude"]
    found = found.where(is_included(*flags)).drop(*flags)
    return derive_codes(found).withColumns({
        f"{name}_drvd": codes.reinsurance("gl_full_source_code", column) for name, column in REINSURANCE.items()
    } | {"default_amount_drvd": codes.amount("default_amount")}).drop(*[
        c for c in reinsurance.columns if c not in ("legal_entity", "center_code")])


def most_lines(rows: DataFrame, subledgers: DataFrame, ledgers: DataFrame, reinsurance: DataFrame) -> int:
    """No header has more lines than this, by one pass over a few columns of ``rows`` before their lookups.

    Lines of one header agree in the columns counted by, and a lookup multiplies a line by the rows of its key at most.
    """
    alike = rows.groupBy(F.xxhash64(
        "gl_application_area_code", F.substring("gl_source_code", 1, 3), F.substring("secondary_ledger_code", 3, 2),
        "transaction_date", "data_type"))
    keys = [(subledgers, ["_area", "_source"]), (ledgers, ["_ledger", "_company"]),
            (reinsurance, ["legal_entity", "center_code"])]
    counts = [alike.count(), *[lookup.groupBy(*k).count() for lookup, k in keys]]
    largest = reduce(DataFrame.unionByName, [
        c.agg(F.greatest(F.max("count"), F.lit(1)).alias("most")) for c in counts]).collect()
    return reduce(lambda a, b: a * b, [r["most"] for r in largest])


# Lines a task of the shuffle should hold: its sorts stay in memory then.
TASK_LINES = 400_000


def classify_lines(
    prepared: DataFrame, headers: DataFrame, pairs: DataFrame, batch: Batch, within: list[DataFrame] | None = None,
    most: Callable[[], int] | None = None,
) -> DataFrame:
    """Messages, transaction number, outcome and line number of every line row.

    ``headers`` are the batch's headers from :func:`run_headers` and ``pairs``
    the forced ones from :func:`forced_header_pairs`. Lines are shuffled once:
    the line number's window runs over the key the header join has placed them
    by. On their way they carry their texts as one, which sorts as the columns
    that order the lines do. Only where a header has more lines than a task may
    hold (``most`` gives a bound where the tables ``within`` are large) are the
    joined rows written, and such headers numbered apart.
    """
    spread = F.col("random_counter")
    lines = None if within is None else sum(w.count() for w in within)
    limit = groups.group_rows(prepared)
    few = lines is not None and (lines <= limit or most is not None and most() <= limit)
    large = groups.Large() if few else groups.find_large(_with_key(prepared, spread), [KEY])
    told = _with_hard_messages(prepared, pairs, batch)
    texts = compact.text_columns(told, LINE_ORDER)
    # The key goes with the packing: together with the lookups it would be more code than the JVM compiles.
    packed = compact.pack(_with_key(told, spread).drop("random_counter"), texts)
    tasks = -(-(lines or 0) // TASK_LINES)
    if tasks > int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        packed = packed.repartition(tasks, KEY)
    rows = packed.join(headers, KEY, "left").withColumn(
        "_clean", F.col("_able") & F.col("transaction_number").isNotNull()).drop("_able")
    if large.ids:
        rows = materialise(rows, "large-headers")
    numbered = groups.number_rows(rows, [KEY, "_clean"], [compact.PACKED], "line_number",
                                  None if large.ids else large)
    done = compact.unpack(numbered.drop(KEY), texts)
    soft = _when((F.length("hard_error_message") == 0) & ~F.col("_clean"), "Header Errored for RDM Lookup;")
    number = F.when(F.col("_clean"), F.col("line_number"))
    done = done.withColumns({"soft_error_message": soft, "line_number": number})
    return _outcome(done.drop("_clean"), batch)


def _with_hard_messages(rows: DataFrame, pairs: DataFrame, batch: Batch) -> DataFrame:
    """Lines with their hard messages, and whether they are able to be good once they have a transaction number."""
    rows = _with_forced(rows, pairs, batch).withColumn("_forceable", ~date_error())
    hard = messages(
        _when(~F.col("_forceable"), "Header Errored for Date Validation;"),
        _forced_message("gl_source_code"),
        *field_messages("is Invalid from Source;"),
    )
    needed = ["source_system_nm_drvd", "ledger_name_drvd", "event_type_code_drvd", "subledger_short_name_drvd"]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    missing = missing | F.col("reinsuranceassumedcededflag_drvd").eqNullSafe(codes.MISSING)
    rows = rows.withColumn("hard_error_message", hard)
    return rows.withColumn("_able", (F.length("hard_error_message") == 0) & ~missing).drop("_forced", "_forceable")


# Columns that do not enter the accounting id.
NOT_HASHED = ("recorded_timestamp", "cycle_date", "batch_id", "original_batch_id", "original_cycle_date",
              "activity_accounting_id")


def valid_lines(rows: DataFrame, batch: Batch, outbound: bool = False) -> DataFrame:
    """Clean lines with derived attributes and accounting id."""
    attributes = rules.derived_attributes() | {n: F.col(f"{n}_drvd") for n in REINSURANCE}
    clean = rows.where(F.length("error_message") == 0)
    numbered = clean.withColumns(attributes | {"source_system_name": F.lit(batch.source_system)})
    hashed = [c for c in LINE_TABLE if c not in NOT_HASHED]
    # The line number keeps copies apart, so no second numbering is needed.
    amounts = numbered.withColumnRenamed("default_amount", "_raw_amount").withColumnRenamed(
        "default_amount_drvd", "default_amount")
    keyed = amounts.withColumn(
        "activity_accounting_id", identity.accounting_id(hashed, batch.run_ts, outbound))
    return keyed.withColumnRenamed("default_amount", "default_amount_drvd").withColumnRenamed(
        "_raw_amount", "default_amount")


LINE_TABLE = [
    "recorded_timestamp", "source_system_name", "original_cycle_date", "original_batch_id",
    "activity_accounting_id", "transaction_number", "line_number", "default_amount", "debit_credit_indicator",
    *LINE_ORDER[2:], "contractsourcesystemname", "contractnumber", "groupcontractnumber",
    "activitywithholdingtaxjurisdiction", "statutoryresidentstatecode", "sourceagentidentifier",
    "activitydepositsourcebatchidentifier", "checknumber", "activitysourceclaimidentifier",
    "activitysourceoriginatinguserid", *REINSURANCE, "reinsurancecounterpartytype",
    "sourcesystemreinsurancecounterpartycode", "cycle_date", "batch_id",
]


def final_lines(valid: DataFrame, batch: Batch) -> DataFrame:
    """Valid lines in table form; reprocessed ones keep where they came from."""
    own = batch.originates()
    return valid.drop("default_amount").withColumns({
        "recorded_timestamp": batch.recorded(),
        "default_amount": F.col("default_amount_drvd"),
        "original_cycle_date": F.when(~own, F.col("original_cycle_date")),
        "original_batch_id": F.when(~own, F.col("original_batch_id")),
        "cycle_date": batch.cycle(),
        "batch_id": batch.number(),
    }).select(*LINE_TABLE)
