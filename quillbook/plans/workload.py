"""Ledger inputs derived from the star-schema tables the queries run on.

The projections are SQL text that Spark and an ANSI checker read alike, so
that both start from the same rows. Every row of the table behind an input is
used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from quillbook.operators.batch import Batch
from quillbook.plans.load import Lookups, Outcome, load_headers, load_lines
from quillbook.session import STAGE_CODEC, materialise, stage_path

CYCLE = date(2025, 12, 5)
RUN_TS = datetime(2025, 12, 8, 8, 30, 15)
HEADER_BATCH = Batch("core", "general_ledger_header", CYCLE, 700042, RUN_TS)
LINE_BATCH = Batch("core", "general_ledger_line_item", CYCLE, 700042, RUN_TS)

PREFIXES = "903 851 444 545 038 863 HIP 049 041 062 165 143 057 147 146 141 668 A4V".split()
ACCOUNTS = """2861600 1120300 2872400 9100000 9900000 2898000 1110900 4111000 7000000 10A1200
VOID123 2891900""".split()


def _choice(index: str, values: list[str], other: str) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {whens} else {other} end"


def _prefix(key: str) -> str:
    return _choice(f"{key} % 20", PREFIXES, f"case when {key} % 20 = 18 then '12' else '0 7Z' end")


def _company(key: str) -> str:
    suffix = _choice(f"{key} % 6", ["01", "02", "03", "04", "05"], "'0'")
    return f"lpad(cast({key} % 10 as string), 2, '0') || {suffix}"


_CENTER = "'C' || lpad(cast({key} % 50 as string), 3, '0')"
_DISCOUNT = "cast(round(l_discount * 100) as bigint)"
_TAX = "cast(round(l_tax * 100) as bigint)"
_DAY = "year(l_shipdate) * 1000 + month(l_shipdate) * 28"
_CENTS = "cast(round(l_extendedprice * 100) as bigint)"

# One raw transaction per line item. Defects sit in single codes: bad dates under
# prefix 545, early reversals under 668, malformed prefixes, companies and amounts.
RAW_COLUMNS = f"""
 20251205 as cycle_date,
 l_returnflag as extract_name,
 case when l_partkey % 20 = 3 and {_TAX} = 8 and {_DISCOUNT} > 7
      then cast(year(l_shipdate) * 1000 + 399 as string) else cast({_DAY} as string) end as fsi_gl_pt_effective_date,
 case when {_DISCOUNT} = 1 then '0' when {_DISCOUNT} = 2 then ' '
      when l_partkey % 20 = 16 and {_TAX} = 7 then cast({_DAY} - 5 as string)
      when {_DISCOUNT} = 3 then cast({_DAY} + 7 as string) end as fsi_gl_bh_rev_effective_date,
 case when l_suppkey % 97 = 13 then '  ' when l_linestatus = 'O' then ' AR ' else 'GL' end
      as fsi_gl_bh_application_area,
 {_prefix('l_partkey')} || case when l_partkey % 20 = 18 then '' else l_linestatus || ' ' end
      as fsi_gl_pt_source_code,
 {_company('l_suppkey')} as fsi_gl_pt_company,
 {_choice('l_partkey % 12', ACCOUNTS, "''")} as fsi_gl_pt_account,
 case when {_TAX} = 7 and {_DISCOUNT} = 9 then '-' || cast({_CENTS} as string)
      when {_TAX} = 7 and {_DISCOUNT} = 8 then ' ' when {_TAX} = 7 and {_DISCOUNT} = 7 then 'N/A'
      else cast({_CENTS} as string) end as fsi_gl_pt_amount,
 {_choice('l_linenumber', ['99', '10', '60', 'DR', 'CR', '13', '63'], "'99'")} as fsi_gl_pt_dr_cr_code,
 'D' || lpad(cast(l_orderkey as string), 10, '0') as fsi_gl_pt_source_document_id,
 {_CENTER.format(key='l_suppkey')} as fsi_gl_pt_center,
 'PRJ' || cast(l_suppkey % 13 as string) as fsi_gl_pt_project_code,
 case when l_partkey % 7 = 0 then 'OTCKC ' when l_partkey % 7 = 1 then 'Café ' else 'POL' end
      || lpad(cast(l_partkey as string), 9, '0') || ' NYCT ' || cast(l_suppkey as string)
      || ' DTCCK reference' as fsi_gl_pt_description_1,
 case when l_suppkey % 3 = 0 then 'TA' when l_suppkey % 3 = 1 then 'N' else 'B' end
      || cast(l_suppkey as string) as fsi_gl_pt_description_2,
 'AG' || cast(l_partkey % 100 as string) as fsi_gl_pt_description_3"""

RAW_SQL = f"select {RAW_COLUMNS} from lineitem"

# Lookup of subledgers: prefix and application area. 165 is excluded, 062 says nothing,
# A4V is missing, 146 has no subledger, 041 also has a row that is out of force.
_AREA_ROW = """select distinct 'EV' || {p} || '{a}' as evnt_typ_cd, 'SRC_' || {p} as src_sys_nm_desc,
 '{a}' as actvty_gl_app_area_cd, {p} as actvty_gl_src_cd,
 case when p_partkey % 20 <> 14 then 'SL' || cast(p_partkey % 20 % 3 as string) end as subledger_nm,
 case when p_partkey % 20 = 10 then 'Exclude' when p_partkey % 20 <> 9 then 'Include' end as include_exclude,
 date '2000-01-01' as eff_strt_dt, date '9999-12-31' as eff_stop_dt
 from part where {p} not in ('12', '0 7Z', 'A4V')"""
_P = _prefix("p_partkey")
SUBLEDGER_SQL = f"""{_AREA_ROW.format(p=_P, a='AR')} union all {_AREA_ROW.format(p=_P, a='GL')} union all
select distinct 'EVOLD', 'SRC_OLD', 'GL', {_P}, 'SL9', 'Include', date '2000-01-01', date '2019-12-31'
 from part where {_P} = '041'"""

# Lookup of ledgers: company. Companies of entity 03 and ledger 04 are excluded, entity 09 and ledger 04 is missing.
_C = _company("s_suppkey")
LEDGER_SQL = f"""select distinct substr({_C}, 3, 2) as actvty_gl_ldgr_cd, 'LEDGER_' || substr({_C}, 3, 2) as ledger_nm,
 {_C} as sec_ldgr_cd, case when s_suppkey % 10 = 3 and s_suppkey % 6 = 3 then 'Exclude' else 'Include' end as include_exclude,
 date '2000-01-01' as eff_strt_dt, date '9999-12-31' as eff_stop_dt
 from supplier where {_C} <> '0904'"""

# Reinsurance attributes: legal entity and center, several versions, none for center C011.
REINSURANCE_SQL = f"""select lpad(cast(s_suppkey % 10 as string), 2, '0') as legal_entity, {_CENTER.format(key='s_suppkey')} as center_code,
 'T' || cast(s_suppkey % 10 as string) as treaty_name,
 case when s_suppkey % 4 = 0 then 'A' else 'C' end as reinsurance_assumed_ceded_flag,
 'AF' || cast(s_suppkey % 3 as string) as reinsurance_account_flag, 'BASIS' || cast(s_suppkey % 7 as string) as reinsurance_basis,
 'TB' || cast(s_suppkey % 5 as string) as type_of_business_reinsured, 'G' as reinsurance_group_individual_flag,
 s_suppkey as rcd_crtd_dt from supplier where {_CENTER.format(key='s_suppkey')} <> 'C011'"""

EXTRACTS = ("A", "N", "R")
# The same lookups once the missing rows have been added.
COMPLETE_SUBLEDGER_SQL = SUBLEDGER_SQL.replace("('12', '0 7Z', 'A4V')", "('12', '0 7Z')")
COMPLETE_LEDGER_SQL = LEDGER_SQL.replace(f" where {_C} <> '0904'", "")
LOOKUPS = {"subledgers": SUBLEDGER_SQL, "ledgers": LEDGER_SQL, "reinsurance": REINSURANCE_SQL}
TABLES = "region nation customer supplier part orders lineitem events".split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(spark: SparkSession, folder: str, sql: str, **given: DataFrame) -> DataFrame:
    """Run a derivation over the tables it names, or over what is ``given`` for them."""
    names = {n: given[n] if n in given else table(spark, folder, n) for n in TABLES if f" {n}" in sql}
    for n in names:
        sql = sql.replace(f"from {n}", f"from {{{n}}}").replace(f"join {n}", f"join {{{n}}}")
    return spark.sql(sql, **names)


_prepared: dict[str, dict[str, DataFrame]] | None = None


@contextmanager
def inputs() -> Iterator[None]:
    """Within this context an input table is written once; it belongs to the caller, not to the session.

    A query opens one for itself, so it starts from the tables alone. Tests and
    the bench open one around several queries, which then share their inputs.
    """
    global _prepared
    before = _prepared
    _prepared = {} if before is None else before
    try:
        yield
    finally:
        _prepared = before


def _input(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {} if _prepared is None else _prepared.setdefault(folder, {})


def extracts(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The three raw extracts: tables partitioned by cycle date, written once per context."""
    made = _input(spark, folder)
    if "A" not in made:
        rows = table(spark, folder, "lineitem")
        raw = spark.sql(f"select {RAW_COLUMNS} from {{rows}}", rows=rows)
        path = stage_path(spark, "raw")
        raw.write.option("compression", STAGE_CODEC).partitionBy("extract_name", "cycle_date").parquet(path)
        made.update({name: spark.read.parquet(f"{path}/extract_name={name}") for name in EXTRACTS})
    return [made[name] for name in EXTRACTS]


def written(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """An input table, written on first use in a context."""
    made = _input(spark, folder)
    if name not in made:
        made[name] = materialise(make(), name)
    return made[name]


def lookups(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The reference tables, written once so that their size is known to the planner."""
    return {
        name: written(spark, folder, name, lambda sql=sql: query(spark, folder, sql)) for name, sql in LOOKUPS.items()
    }


def loaded_headers(spark: SparkSession, folder: str) -> Outcome:
    """The header load of the workload batch, run once per context."""
    made = _input(spark, folder)
    if "headers" not in made:
        made["headers"] = load_headers(extracts(spark, folder), Lookups(**lookups(spark, folder)), HEADER_BATCH)
    return made["headers"]


def loaded_lines(spark: SparkSession, folder: str) -> Outcome:
    """The line load of the workload batch, run once per context."""
    made = _input(spark, folder)
    if "lines" not in made:
        made["lines"] = load_lines(
            extracts(spark, folder), Lookups(**lookups(spark, folder)), loaded_headers(spark, folder), LINE_BATCH)
    return made["lines"]
