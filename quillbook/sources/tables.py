"""Partitioned tables as sinks: append, replace, clear, back up, project."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillbook.session import control_table


def in_table_order(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name in target order and type; missing ones as typed nulls."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def create(
    spark: SparkSession, table: str, schema: StructType, partitions: list[str], path: str | None = None
) -> None:
    """An empty partitioned table, unless it is there already."""
    if spark.catalog.tableExists(table):
        return
    writer = spark.createDataFrame([], schema).write.partitionBy(*partitions).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    target = df.sparkSession.table(table).schema
    in_table_order(df, target).write.mode("append").insertInto(table)


@contextmanager
def overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Inserts take the overwrite mode from the session alone."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions present in ``df``."""
    spark = df.sparkSession
    rows = in_table_order(df, spark.table(table).schema)
    with overwriting(spark, "dynamic"):
        rows.write.insertInto(table, overwrite=True)


def _literal(value: object) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def clear_partition(spark: SparkSession, table: str, values: dict[str, object]) -> None:
    """Empty one partition.

    Dynamic overwriting with no rows would leave it as it was, and dropping it
    would leave the files of an external table, so a named partition is
    overwritten with nothing.
    """
    spec = ", ".join(f"`{k}`={_literal(v)}" for k, v in values.items())
    fields = [f for f in spark.table(table).schema.fields if f.name not in values]
    nothing = spark.createDataFrame([], StructType(fields))
    with overwriting(spark, "static"):
        spark.sql(f"insert overwrite table {table} partition ({spec}) select * from {{nothing}}", nothing=nothing)


def replace_partition(df: DataFrame, table: str, values: dict[str, object]) -> None:
    """Make ``df`` the whole content of one partition, also when it is empty."""
    if df.isEmpty():
        clear_partition(df.sparkSession, table, values)
    else:
        overwrite_partitions(df, table)


def truncate_and_load(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    rows = in_table_order(df, spark.table(table).schema)
    with overwriting(spark, "static"):
        rows.write.insertInto(table, overwrite=True)


def without_batches(target: DataFrame, batches: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows of all batches but the given ones."""
    return target.join(control_table(batches.select(*keys)), keys, "left_anti")


def replace_batches(target: DataFrame, rows: DataFrame, batches: DataFrame, keys: list[str]) -> DataFrame:
    """Idempotent load: rows of the batches are replaced, the others stay."""
    return without_batches(target, batches, keys).unionByName(rows, allowMissingColumns=True)


def back_up(df: DataFrame, folder: str) -> None:
    """Copy rows to a new folder, keeping the partition layout of the error table."""
    df.write.mode("errorifexists").partitionBy("table_name", "reprocess_flag").parquet(folder)


def backup_rows(errors: DataFrame, table_name: str, kind: str, reprocess_flag: str | None = None) -> DataFrame:
    """Rows a backup of the given kind holds."""
    rows = errors.where(F.col("table_name") == table_name)
    if kind in ("full_backup", "rerun_full_backup", "full_backup_aged") and reprocess_flag is None:
        return rows
    if kind == "rerun" and reprocess_flag is not None:
        return rows.where(F.col("reprocess_flag") == reprocess_flag)
    raise ValueError(f"backup kind {kind!r} does not go with reprocess flag {reprocess_flag!r}")


def projection(df: DataFrame, columns: list[str]) -> DataFrame:
    """A fixed column list over a table whose columns may lag behind."""
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns
    ])


def matches(values: dict[str, object]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in values.items()])


# Columns of the current header and line views.
HEADER_VIEW = """transaction_number secondary_ledger_code ledger_name subledger_short_name event_type_code
source_system_nm data_type transaction_date header_description gl_application_area_code gl_reversal_date
gl_source_code source_system_name cycledate batchid original_cycle_date original_batch_id inserttimestamp
updatetimestamp sourceactivityparentid reinsurancetreatynumber""".split()

LINE_VIEW = """activity_accounting_id transaction_number line_number sourceaccountingid default_currency
default_amount debit_credit_indicator gl_full_source_code orig_gl_source_document_id orig_gl_company
orig_gl_account orig_gl_center orig_gl_description_1 orig_gl_description_2 orig_gl_description_3
orig_gl_project_code groupcontractnumber contractnumber contractsourcesystemname contractstatuscode
ifrs17cohort ifrs17grouping ifrs17measurementmodel ifrs17portfolio ifrs17profitability
ifrs17reportingcashflowtype sourcesystemactivitytypedescription statutoryresidentcountrycode
statutoryresidentstatecode activitydepositsourcebatchidentifier activityreversalcode
activitysourceclaimidentifier activitysourceoriginatinguserid activitysourcetransactionid
activitywithholdingtaxjurisdiction activitywithholdingtaxjurisdictioncountrycode checknumber
contractissuedate contractissuestatecode contractsourceorganizationcode plancode
reinsuranceassumedcededflag reinsurancecounterpartyreportinggroup reinsurancecounterpartytype
reinsurancetreatybasis reinsurancetreatyname sourceagentidentifier sourcefundidentifier
sourcesystemgeneralledgeraccountnumber sourcesystemgroupcontractnumber
sourcesystemreinsurancecounterpartycode line_description source_system_name cycledate batchid
original_cycle_date original_batch_id inserttimestamp updatetimestamp investmentportfoliocode
instrumentcode assetclasscode activitytypegroup activitytype activityamounttype
contractadministrationlocationcode contractsourceaccountingcenterdeviator contracteffectivedate
contractdurationinyears contractbillingmode contractgroupindicator contractmodelpremium
contractproductfundmortalityandexpensecode contractproducttypecode payoutoptionindicator
activitysourceaccountingememcode activitysourceaccountingdeviator
activityaccountingbalanceentryindicator activityeffectivedate activitymoneyethodcode
distributionreasoncode fundclassindicator fundnumber fundunits 1035exchangeindicator icginputflag
modifiedcompanyentryflag primaryinsuredprimarypostalcode primaryannuitantnonresidentaliantaxstatus
ownernonresidentaliantaxstatus sourcelegalentitycode cessionidentifier contractparticipationindicator
transactionclass transactionrideritype transactionchargetype transactionfeetype transactiontaxtype
contractissueage reinsuranceaccountflag reinsurancegroupindividualflag typeofbusinessreinsured
reinsurancetreatycomponentidentifier reinsurancemultiplier treatyruleset majorlineofbusiness
claimsproductidentifier managementcode""".split()

HEADER_ERROR_VIEW = """source_system_nm ledger_name subledger_short_name event_type_code transaction_date
gl_reversal_date gl_application_area_code gl_source_code secondary_ledger_code data_type
sourceactivityparentid header_description activitytypegroup activitytype activityamounttype
fundclassindicator ifrs17grouping ifrs17portfolio ifrs17profitability ifrs17cohort plancode fundnumber
sourcelegalentitycode orig_gl_account orig_gl_company orig_gl_center gl_full_source_code
sourcesystemgeneralledgeraccountnumber contractissuedate src_desc reinsurancetreatynumber""".split()

LINE_ERROR_VIEW = """source_system_nm ledger_name subledger_short_name event_type_code transaction_date
gl_reversal_date gl_application_area_code gl_source_code secondary_ledger_code data_type default_currency
default_amount debit_credit_indicator orig_gl_source_document_id orig_gl_company orig_gl_account
orig_gl_center orig_gl_description_1 orig_gl_description_2 orig_gl_description_3 orig_gl_project_code
groupcontractnumber contractnumber contractsourcesystemname contractstatuscode contractissueage
statutoryresidentstatecode sourcesystemactivitytypedescription activitydepositsourcebatchidentifier
activityreversalcode activitysourceclaimidentifier activitysourceoriginatinguserid
activitysourcetransactioncode activitywithholdingtaxjurisdiction
activitywithholdingtaxjurisdictioncountrycode checknumber contractissuedate contractissuestatecode
contractsourcemarketingorganizationcode plancode reinsuranceassumedcededflag
reinsurancecounterpartyreportinggroup reinsurancecounterpartytype reinsurancetreatybasis
reinsurancetreatyname sourceagentidentifier reinsuranceaccountflag sourcefundidentifier
sourcesystemgeneralledgeraccountnumber sourcesystemgroupcontractnumber
sourcesystemreinsurancecounterpartycode line_description investmentportfoliocode instrumentcode
assetclasscode activitytypegroup activitytype activityamounttype contractadministrationlocationcode
contractsourceaccountingcenterdeviator contracteffectivedate contractdurationinyears contractbillingmode
contractgroupindicator contractmodelpremium contractproductfundmortalityandexpensecode
contractproducttypecode payoutoptionindicator activitysourceaccountingememcode
activitysourceaccountingdeviator activityaccountingbalanceentryindicator activityeffectivedate
activitymoneyethodcode distributionreasoncode fundclassindicator fundnumber fundunits
1035exchangeindicator primaryinsuredprimarypostalcode primaryannuitantnonresidentaliantaxstatus
ownernonresidentaliantaxstatus sourcelegalentitycode contractparticipationindicator sourceaccountingid
majorlineofbusiness claimsproductidentifier managementcode src_desc""".split()
