"""Raw transaction extracts and reference lookups as canonical rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbook.functions import codes

# Canonical column -> raw extract column.
HEADER_FIELDS = {
    "transaction_date": "fsi_gl_pt_effective_date",
    "gl_reversal_date": "fsi_gl_bh_rev_effective_date",
    "gl_application_area_code": "fsi_gl_bh_application_area",
    "gl_source_code": "fsi_gl_pt_source_code",
    "secondary_ledger_code": "fsi_gl_pt_company",
    "gl_full_source_code": "fsi_gl_pt_source_code",
    "orig_gl_center": "fsi_gl_pt_center",
}
LINE_FIELDS = HEADER_FIELDS | {
    "default_amount": "fsi_gl_pt_amount",
    "orig_gl_source_document_id": "fsi_gl_pt_source_document_id",
    "orig_gl_company": "fsi_gl_pt_company",
    "orig_gl_account": "fsi_gl_pt_account",
    "orig_gl_project_code": "fsi_gl_pt_project_code",
}
DESCRIPTIONS = {f"orig_gl_description_{i}": f"fsi_gl_pt_description_{i}" for i in (1, 2, 3)}


def _canonical(fields: dict[str, str]) -> list[Column]:
    columns = [F.trim(raw).alias(name) for name, raw in fields.items()]
    return [*columns, codes.data_type(F.trim("fsi_gl_pt_account")).alias("data_type")]


def _cycle(extracts: list[DataFrame], cycle_date: int) -> list[DataFrame]:
    # The extracts are partitioned by cycle_date, so this prunes files.
    return [e.where(F.col("cycle_date") == cycle_date) for e in extracts]


def header_rows(extracts: list[DataFrame], cycle_date: int) -> DataFrame:
    """Distinct header rows over all extracts of a cycle."""
    rows = [e.select(*_canonical(HEADER_FIELDS)) for e in _cycle(extracts, cycle_date)]
    return reduce(DataFrame.unionByName, rows).distinct()


def line_rows(extracts: list[DataFrame], cycle_date: int) -> DataFrame:
    """All line rows over all extracts of a cycle; copies stay."""
    columns = [
        *_canonical(LINE_FIELDS),
        codes.debit_credit(F.trim("fsi_gl_pt_dr_cr_code")).alias("debit_credit_indicator"),
        *[codes.ascii_only(F.trim(raw)).alias(name) for name, raw in DESCRIPTIONS.items()],
        # Taken at the scan, where a repeated task numbers its rows alike.
        F.monotonically_increasing_id().alias("random_counter"),
    ]
    return reduce(DataFrame.unionByName, [e.select(*columns) for e in _cycle(extracts, cycle_date)])


def effective(lookup: DataFrame, on: Column, start: str = "eff_strt_dt", stop: str = "eff_stop_dt") -> DataFrame:
    """Lookup rows in force on a date."""
    return lookup.where(on.between(F.col(start), F.col(stop))).drop(start, stop)


def latest(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """The newest row per key.

    Filtering ``row_number`` on 1 lets Spark keep one row per key and task
    before the shuffle, so a key of any size costs one row per task.
    """
    return nth_latest(df, keys, newest, 1)


def nth_latest(df: DataFrame, keys: list[str], newest: list[str], n: int) -> DataFrame:
    """The n-th newest row per key."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest])
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == n).drop("_rank")


def subledger_map(lookup: DataFrame, on: Column) -> DataFrame:
    return effective(lookup, on).select(
        F.col("actvty_gl_app_area_cd").alias("_area"),
        F.col("actvty_gl_src_cd").alias("_source"),
        F.col("src_sys_nm_desc").alias("source_system_nm_drvd"),
        F.col("evnt_typ_cd").alias("event_type_code_drvd"),
        F.col("subledger_nm").alias("subledger_short_name_drvd"),
        F.col("include_exclude").alias("sblgdr_include_exclude"),
    )


def ledger_map(lookup: DataFrame, on: Column) -> DataFrame:
    return effective(lookup, on).select(
        F.col("actvty_gl_ldgr_cd").alias("_ledger"),
        F.col("sec_ldgr_cd").alias("_company"),
        F.col("ledger_nm").alias("ledger_name_drvd"),
        F.col("include_exclude").alias("ldgr_include_exclude"),
    )


def reinsurance_map(lookup: DataFrame) -> DataFrame:
    """Newest attributes per treaty, legal entity and center."""
    return latest(lookup, ["treaty_name", "legal_entity", "center_code"], ["rcd_crtd_dt"])


def combined_window(
    tables: dict[str, DataFrame], cycle_date: Column, days: int = 30
) -> DataFrame:
    """The last days of several tables with aligned columns and their origin."""
    rows = [
        df.where(F.col("cycle_date").between(F.date_sub(cycle_date, days), cycle_date))
        .withColumn("source_table", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def existing_tables(spark, names: list[str]) -> dict[str, DataFrame]:
    """Those of the named tables that the catalog knows."""
    return {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}
