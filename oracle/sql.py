"""The same results in ANSI SQL, written apart from the Spark operators.

Shared are the derivation of the ledger inputs, so that both sides start from
the same rows, and the lists of columns that records and views have.
"""

from __future__ import annotations

import re

from quillbook.operators import errors
from quillbook.plans import queries as q
from quillbook.plans import workload as w
from quillbook.sources.tables import HEADER_ERROR_VIEW, HEADER_VIEW, LINE_ERROR_VIEW, LINE_VIEW

ORACLE: dict[str, str] = {}

# Ledger classification.

BASE = f"""
raw as ({w.RAW_SQL}),
subledgers as ({w.SUBLEDGER_SQL}),
ledgers as ({w.LEDGER_SQL}),
reins_all as ({w.REINSURANCE_SQL}),
reins as (select * from reins_all qualify row_number() over (
  partition by treaty_name, legal_entity, center_code order by rcd_crtd_dt desc) = 1),
lines0 as (select
  trim(fsi_gl_pt_effective_date) as transaction_date, trim(fsi_gl_bh_rev_effective_date) as gl_reversal_date,
  trim(fsi_gl_bh_application_area) as gl_application_area_code, trim(fsi_gl_pt_source_code) as gl_source_code,
  trim(fsi_gl_pt_company) as secondary_ledger_code, trim(fsi_gl_pt_source_code) as gl_full_source_code,
  trim(fsi_gl_pt_center) as orig_gl_center, trim(fsi_gl_pt_amount) as default_amount,
  trim(fsi_gl_pt_source_document_id) as orig_gl_source_document_id, trim(fsi_gl_pt_company) as orig_gl_company,
  trim(fsi_gl_pt_account) as orig_gl_account, trim(fsi_gl_pt_project_code) as orig_gl_project_code,
  case when trim(fsi_gl_pt_account) like '9%' and trim(fsi_gl_pt_account) not like '99%' then 'Statistical' else 'Financial' end as data_type,
  case when trim(fsi_gl_pt_dr_cr_code) in ('10','13','DR') then 'Debit'
       when trim(fsi_gl_pt_dr_cr_code) in ('60','63','CR') then 'Credit' end as debit_credit_indicator,
  replace(trim(fsi_gl_pt_description_1), 'é', '') as orig_gl_description_1,
  trim(fsi_gl_pt_description_2) as orig_gl_description_2, trim(fsi_gl_pt_description_3) as orig_gl_description_3
  from raw),
headers0 as (select distinct transaction_date, gl_reversal_date, gl_application_area_code, gl_source_code,
  secondary_ledger_code, gl_full_source_code, orig_gl_center, data_type from lines0)"""

_DERIVED = """
  case when length(substr(gl_source_code,1,3)) = 3 and substr(gl_source_code,1,3) not like '% %' then substr(gl_source_code,1,3) end as src,
  case when length(trim(substr(secondary_ledger_code,3,2))) = 2 then substr(secondary_ledger_code,3,2) end as ldg,
  cast(try_strptime(transaction_date, '%Y%j') as date) as tdate,
  cast(try_strptime(gl_reversal_date, '%Y%j') as date) as rdate,
  try_strptime(transaction_date, '%Y%j') is not null as tchk,
  (gl_reversal_date is null or gl_reversal_date in ('', '0') or try_strptime(gl_reversal_date, '%Y%j') is not null) as rchk,
  coalesce(try_cast(gl_reversal_date as int), 0) > 0 and coalesce(try_cast(transaction_date as int), 0) > coalesce(try_cast(gl_reversal_date as int), 0) as early"""


def _joined(name: str, reins: str, attributes: str) -> str:
    return f"""
  select a.*, {_DERIVED}, c.ledger_nm as ledger, b.src_sys_nm_desc as sys, b.evnt_typ_cd as evt, b.subledger_nm as sub,
   {attributes}, b.include_exclude as s_flag, c.include_exclude as l_flag
  from {name} a
  left join (select * from subledgers where date '2025-12-05' between eff_strt_dt and eff_stop_dt) b
    on a.gl_application_area_code = b.actvty_gl_app_area_cd and substr(a.gl_source_code,1,3) = b.actvty_gl_src_cd
  left join ledgers c on substr(a.secondary_ledger_code,3,2) = c.actvty_gl_ldgr_cd and a.secondary_ledger_code = c.sec_ldgr_cd
  left join {reins} d on substr(a.secondary_ledger_code,1,2) = d.legal_entity and a.orig_gl_center = d.center_code"""


_FLAG = """case when substr(gl_full_source_code,1,3) in ('903','851','444') then coalesce(d.{0}, '@') end as {1}"""
_HEADER_FLAG = _FLAG.format("reinsurance_assumed_ceded_flag", "flag")
_GRAIN = "ledger, sys, evt, sub, src, gl_application_area_code, tdate, data_type, rdate, ldg"
_ORDER = ", ".join(f"{c} nulls first" for c in _GRAIN.split(", "))
_SAME = " and ".join(
    f"a.{c} is not distinct from b.{c}" if c == "rdate" else f"a.{c} = b.{c}" for c in _GRAIN.split(", "))
_LEDGER_BAD = "coalesce(length(secondary_ledger_code) < 4 or substr(secondary_ledger_code,3,2) like '% %', true)"
_PAIR = "'gl_application_area_code (' || coalesce(gl_application_area_code,'') || ') and gl_source_code (' || coalesce(substr(gl_source_code,1,3),'') || ');'"

HEADERS = BASE + f""",
flags as (select distinct legal_entity, center_code, reinsurance_assumed_ceded_flag from reins),
h1 as ({_joined('headers0', 'flags', _HEADER_FLAG)}),
h2 as (select * from h1 where coalesce(s_flag,'Include') = 'Include' and coalesce(l_flag,'Include') = 'Include'),
h3 as (select *, max(case when flag = '@' then 1 else 0 end) over (partition by {_GRAIN}) as bad,
  not tchk or not rchk or early as dated from h2),
keys as (select *, substr(evt,1,6) || '20251208083015000_' || row_number() over (partition by substr(evt,1,6) order by {_ORDER}) as txn
  from (select distinct {_GRAIN} from h3 where ledger is not null and sys is not null and evt is not null and sub is not null
    and src is not null and ldg is not null and tdate is not null and not dated and bad = 0 and length(gl_application_area_code) > 0)),
h4 as (select a.*, b.txn,
  case when not tchk then coalesce(transaction_date,'') || ' transaction_date is in invalid format, expected yyyyjjj;' else '' end
  || case when not rchk then coalesce(gl_reversal_date,'') || ' gl_reversal_date is in invalid format, expected yyyyjjj;' else '' end
  || case when early then case when a.tdate is null then 'null' else transaction_date end || ' > '
       || case when a.rdate is null then 'null' else gl_reversal_date end || ' transaction_date is greater than gl_reversal_date;' else '' end
  || case when coalesce(length(a.gl_application_area_code),0) = 0 then coalesce(a.gl_application_area_code,'blank/null') || ' gl_application_area_code is invalid from source;' else '' end
  || case when a.src is null then coalesce(gl_source_code,'blank/null') || ' gl_source_code is invalid from source;' else '' end
  || case when {_LEDGER_BAD} then coalesce(secondary_ledger_code,'blank/null') || ' secondary_ledger_code is invalid from source;' else '' end as own_raw
  from h3 a left join keys b on {_SAME}),
h5 as (select *, trim(own_raw) as own, trim(case when trim(own_raw) <> '' then '' else
  case when sys is null or evt is null then 'source_system_nm/event_type_code is missing in rdm table subledger_names for key combination ' || {_PAIR} else '' end
  || case when ledger is null then 'ledger_name is missing in rdm table ledger_names for key combination actvty_gl_ldgr_cd/secondary_ledger_code_drvd ('
      || coalesce(substr(secondary_ledger_code,3,2),'') || ') and secondary_ledger_code (' || coalesce(secondary_ledger_code,'') || ');' else '' end
  || case when sub is null then 'subledger_short_name is missing in rdm table subledger_names for key combination ' || {_PAIR} else '' end
  || case when txn is null then 'transaction_number is invalid;' else '' end
  || case when flag = '@' then 'reinsuranceassumedcededflag is missing in rdm table reinsurance_attributes for key combination secondary_ledger_code ('
      || coalesce(substr(secondary_ledger_code,1,2),'') || ') and orig_gl_center (' || coalesce(orig_gl_center,'') || ');' else '' end
  end) as soft from h4),
hpairs as (select gl_application_area_code as f_area, src as f_src from h5 where gl_application_area_code is not null and src is not null
  group by 1, 2 having bool_or(dated) and bool_or(own = '' and soft = '')),
h6 as (select h5.*, trim(case when f_area is not null and own = '' then 'Forced Error. Date Errors Present in Other Headers for combination of gl_application_area_code ('
  || coalesce(gl_application_area_code,'') || ') and gl_source_code (' || coalesce(src,'') || ');' else '' end || own) as hard
  from h5 left join hpairs on gl_application_area_code = f_area and src = f_src),
hfinal as (select *, case when hard <> '' then 'N' when soft <> '' then 'Y' end as flag_out,
  case when hard <> '' then 'Hard Error' when soft <> '' then 'Soft Error' else 'Good' end as outcome from h6)"""

# Rows of a batch without a number count as one transaction; any lookup error in it turns the others hard.
FORCED_HEADERS = HEADERS + """,
w5 as (select *, contains(upper(hard || soft), 'RDM') as own_rdm, bool_or(contains(upper(hard || soft), 'RDM')) over (partition by txn) as any_rdm from hfinal),
hforced as (select * exclude (hard, soft, flag_out, outcome),
  case when any_rdm and not own_rdm then msg else '' end || hard as hard, case when any_rdm and not own_rdm then msg else '' end || soft as soft,
  case when any_rdm and not own_rdm then 'N' else flag_out end as flag_out, case when any_rdm and not own_rdm then 'Hard Error' else outcome end as outcome
  from (select *, 'XForced Error. Hard Errors - Missing RDM Lookup for transaction_number ' || coalesce(txn, 'UNKNOWN') || ';' as msg from w5))"""

_REINS_COLUMNS = {"reinsuranceassumedcededflag": "reinsurance_assumed_ceded_flag", "reinsurancetreatybasis": "reinsurance_basis",
                  "reinsurancetreatynumber": "treaty_name", "typeofbusinessreinsured": "type_of_business_reinsured",
                  "reinsurancegroupindividualflag": "reinsurance_group_individual_flag", "reinsuranceaccountflag": "reinsurance_account_flag"}
_LINE_FLAGS = ", ".join(_FLAG.format(v, k) for k, v in _REINS_COLUMNS.items())
_CENTS = "coalesce(try_cast(default_amount as decimal(20,0)), 0)"
_LINE_ORDER = """default_amount, debit_credit_indicator, gl_full_source_code, orig_gl_source_document_id, orig_gl_company, orig_gl_account,
 orig_gl_center, orig_gl_description_1, orig_gl_description_2, orig_gl_description_3, orig_gl_project_code""".split(",")
_LINE_ORDER = ", ".join(c.strip() + " nulls first" for c in _LINE_ORDER)

LINES = FORCED_HEADERS + f""",
good_headers as (select distinct txn, {_GRAIN} from hforced where outcome = 'Good'),
line_pairs as (select distinct gl_application_area_code as f_area, src as f_src from hforced
  where contains(hard, 'Forced Error. Date Errors Present in Other Headers')),
l1 as ({_joined('lines0', 'reins', _LINE_FLAGS)}),
l2 as (select *, not tchk or not rchk or early as dated,
  case when {_CENTS} > 0 then cast({_CENTS} as double) / 100 else 0 end as amount
  from l1 where coalesce(s_flag,'Include') = 'Include' and coalesce(l_flag,'Include') = 'Include'),
l3 as (select a.*, b.txn, f_area is not null as forced from l2 a left join good_headers b on {_SAME}
  left join line_pairs on a.gl_application_area_code = f_area and a.src = f_src),
l4 as (select *, trim(case when dated then 'Header Errored for Date Validation;' else '' end
  || case when forced and not dated then 'Forced Error. Date Errors Present in Other Headers for combination of gl_application_area_code ('
      || coalesce(gl_application_area_code,'') || ') and gl_source_code (' || coalesce(gl_source_code,'') || ');' else '' end
  || case when coalesce(length(gl_application_area_code),0) = 0 then coalesce(gl_application_area_code,'BLANK/NULL') || ' gl_application_area_code is Invalid from Source;' else '' end
  || case when src is null then coalesce(gl_source_code,'BLANK/NULL') || ' gl_source_code is Invalid from Source;' else '' end
  || case when {_LEDGER_BAD} then coalesce(secondary_ledger_code,'BLANK/NULL') || ' secondary_ledger_code is Invalid from Source;' else '' end) as hard from l3),
l5 as (select *, case when hard = '' and (txn is null or sys is null or ledger is null or evt is null or sub is null
  or coalesce(reinsuranceassumedcededflag,'') = '@') then 'Header Errored for RDM Lookup;' else '' end as soft from l4),
lfinal as (select *, case when hard <> '' then 'Hard Error' when soft <> '' then 'Soft Error' else 'Good' end as outcome,
  case when hard = '' and soft = '' then cast(row_number() over (partition by txn, hard = '' and soft = '' order by {_LINE_ORDER}) as bigint) end as line_number from l5)"""

LINES_FORCED = LINES + """,
lw5 as (select *, contains(upper(hard || soft), 'RDM') as own_rdm, bool_or(contains(upper(hard || soft), 'RDM')) over (partition by txn) as any_rdm from lfinal),
lforced as (select * exclude (hard, soft, outcome),
  case when any_rdm and not own_rdm then msg else '' end || hard as hard, case when any_rdm and not own_rdm then msg else '' end || soft as soft,
  case when any_rdm and not own_rdm then 'Hard Error' else outcome end as outcome
  from (select *, 'XForced Error. Hard Errors - Missing RDM Lookup for transaction_number ' || coalesce(txn, 'UNKNOWN') || ';' as msg from lw5))"""


# The attributes by source prefix, each written out from the rules' description.
_P, _A = "substr(gl_full_source_code, 1, 3)", "orig_gl_account"
_D1, _D2, _D3 = (f"orig_gl_description_{i}" for i in (1, 2, 3))
_DOC = "orig_gl_source_document_id"
_ATTRIBUTES = {
    "contractnumber": f"""case {_P}
      when '545' then substr({_D1}, 1, 10)
      when '038' then case when {_A} like '1%' and {_A} <> '2872400' then trim(substr({_D1}, 1, 10)) end
      when '863' then trim(substr({_D1}, 1, 12)) when '864' then trim(substr({_D1}, 1, 12))
      when 'HIP' then case when {_A} like '2%' then trim(substr({_D1}, 1, 15)) end
      when '049' then trim(substr({_D1}, 1, 28))
      when 'A4V' then case when {_A} like 'VOID%' then trim(substr({_D1}, 6, 10)) end
      when '041' then {_D1}
      when '062' then case when {_A} <> '2861600' then {_D1} end
      when '122' then case when {_A} <> '2861600' then {_D1} end
      when '123' then case when {_A} <> '2861600' then {_D1} end
      when '165' then case when {_A} like '2%' then {_D1} end
      when '147' then case when {_A} like '2%' then {_D1} end
      when '430' then case when {_A} like '2%' then {_D1} end
      when '043' then case when {_A} = '2898000' then {_D2} when {_A} in ('2871100', '2890200', '2891900') then null when {_A} like '2%' then {_D1} end
      when '075' then case when {_A} = '2891900' then {_D1} end
      when '074' then case when {_D1} like '%OTCKC%' then {_D3} end
      when '296' then {_D1} when '456' then {_D1} when '464' then {_D1} when '851' then {_D1} when '959' then {_D1}
      when '143' then case when {_A} not like '19%' and {_A} not like '99%' then {_D2} end
      when '069' then case when {_D2} = 'N' or {_D2} like 'TA%' then {_D2} end
      when '057' then case when {_A} like '829%' or substr({_A}, 1, 1) in ('1', '2', '4', '6', '7') then {_D1} end
      when '145' then case when {_A} = '2893600' then {_D2} when {_A} like '19%' or {_A} like '28%' then {_D1}
        when {_A} like '4%' or {_A} like '7%' then {_D2} end
      end""",
    "groupcontractnumber": f"""case {_P}
      when '146' then case {_A} when '10A1200' then trim(substr({_D1}, 1, 13)) when '2873600' then {_DOC} end
      when '143' then case when {_A} like '19%' or {_A} like '28%' then {_DOC} end end""",
    "activitywithholdingtaxjurisdiction": f"""case
      when {_P} in ('051', '052', '122', '123') then case when {_A} = '2861600' then {_D1} end
      when {_P} = '549' then case when {_A} like '2%' then trim(substr({_D1}, 29, 2)) end
      when {_P} in ('452', '453', '454', '458', '460', '462', '463', '143') then case when {_A} like '1%' then trim(substr({_D1}, 29, 2)) end
      when {_P} = '863' then case when {_A} like '2%' then trim(substr({_D1}, 13, 2)) end end""",
    "sourceagentidentifier": f"""case {_P}
      when '141' then case when {_A} = '1117300' then {_D2} when {_A} in ('1120300', '1120500', '2870500', '2801800') then {_D1} end
      when '146' then case when {_A} = '1120300' then {_D1} end
      when '038' then case when {_A} = '2872400' then trim(substr({_D1}, 1, 10)) end
      when '073' then case when {_A} in ('2871300', '2888900') then {_D2} end
      when '145' then case when {_A} = '2861600' then {_D1} end
      when '039' then case when {_D1} like '%DTCCK%' then {_D2} else {_D3} end
      when '668' then case when {_D1} not like '%NSCCK%' then {_D1} end
      when '057' then case when {_A} like '5%' or substr({_A}, 1, 3) in ('825', '826', '849') or {_A} in ('1120400', '2871100') then {_D1} end
      when '077' then {_D3} end""",
    "activitydepositsourcebatchidentifier": f"""case {_P}
      when '051' then case when {_A} <> '2861600' then {_D2} end
      when '146' then case when {_A} = '10A1200' then trim(substr({_D1}, 14, 17)) when {_A} in ('1004100', '1090900', '1090600') then {_D1}
        when {_A} in ('2890400', '1120300', '1997000', '1910000', '2870500', '2878180', '2891900') then {_D2}
        when substr({_A}, 1, 4) in ('4111', '4121') then right({_DOC}, 8) when {_A} like '7%' then {_DOC} end
      when '402' then case when {_A} in ('10A1200', '2871300') then {_D1} when {_A} = '2893700' then {_D2} end
      when '057' then case when {_A} in ('1110900', '1806200', '2872600', '2872700', '2886500', '2890100', '2898000') then {_D1} end
      when '043' then case when {_A} in ('1110900', '2898000') then {_D1} when {_A} like '10%' or {_A} like '28%' then {_D2} end
      when '038' then case when {_A} like '1%' then {_D1} else {_D2} end
      when '075' then {_D2} when '109' then {_D2}
      when '545' then trim(substr({_D1}, 16, 15)) end""",
    "checknumber": f"""case
      when {_P} = '017' then case when {_D1} not like '%DTCCK%' then {_D2} end
      when {_P} in ('039', '049', '863', '864') then {_D2} when {_P} in ('456', '464') then {_D3} end""",
    "activitysourceclaimidentifier": f"case when {_P} = 'HIP' and {_A} like '2%' then trim(substr({_D1}, 16, 15)) end",
    "activitysourceoriginatinguserid": f"""case {_P} when '038' then case when {_A} not like '1%' then trim(substr({_D1}, 11, 20)) end
      when '141' then case when {_A} like '7%' then {_D2} else orig_gl_project_code end when '545' then trim(substr({_D1}, 11, 5)) end""",
    "contractsourcesystemname": f"case {_P} when '903' then 'External A' when '851' then 'External B' when '444' then 'External B' end",
    "reinsurancecounterpartytype": f"case when {_P} in ('903', '851', '444') then 'External' end",
    "sourcesystemreinsurancecounterpartycode": f"case when {_P} in ('903', '851', '444') then orig_gl_center end",
    "statutoryresidentstatecode": "cast(null as varchar)",
}


def _attributes_sql() -> str:
    return ", ".join(f"{text} as {name}" for name, text in _ATTRIBUTES.items())


def sql(name: str, body: str, common: str = "") -> None:
    ORACLE[name] = f"with {common.strip()} {body}" if common else body


sql("extract_headers", "select * from headers0", BASE)
sql("extract_lines", "select * from lines0", BASE)
sql("derived_codes", f"""select orig_gl_source_document_id, src as gl_source_code_drvd, ldg as secondary_ledger_code_drvd,
 cast(tdate as varchar) as transaction_date_drvd, cast(rdate as varchar) as gl_reversal_date_drvd,
 cast(tchk as varchar) as transaction_date_chk, cast(rchk as varchar) as gl_reversal_date_chk,
 try_cast(substr(transaction_date,1,4) as bigint) as transaction_year,
 case when {_CENTS} > 0 then cast({_CENTS} as double) / 100 else 0 end as ignore_negative,
 cast({_CENTS} as double) / 100 as get_precision, cast({_CENTS} as double) as ignore_precision
 from (select *, {_DERIVED} from lines0)""", BASE)
sql("include_exclude", f"""select s_flag as sblgdr_include_exclude, l_flag as ldgr_include_exclude,
 count(*) filter (coalesce(s_flag,'Include') = 'Include' and coalesce(l_flag,'Include') = 'Include') as included,
 count(*) filter (coalesce(s_flag,'') = 'Exclude' or coalesce(l_flag,'') = 'Exclude') as excluded
 from ({_joined('lines0', 'reins', _LINE_FLAGS)}) group by 1, 2""", BASE)

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority"
for _name, _n in (("lookup_latest", 1), ("lookup_second_latest", 2)):
    sql(_name, f"""select {_ORDERS} from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n from orders) where n = {_n}""")

_TEN = [("event_type_code", "evnt_typ_cd"), ("transaction_class", "trnsctn_cls"), ("source_system_nm", "src_sys_nm"), ("plancode", "cntrct_pln_cd"),
        ("fundclassindicator", "fund_clss"), ("rider_type", "trnsctn_rdr_typ"), ("charge_type", "trnsctn_chrg_typ"), ("fee_type", "trnsctn_fee_typ"),
        ("portfolio", "ifrs17_prtflio"), ("grouping", "ifrs17_groupn")]
_FITS = " and ".join([f"({c} is null or {c} = {r})" for r, c in _TEN[:2]] + ["(alone or (" + " and ".join(
    f"({c} is null or {c} = '-' or ({c} = {r} and trim({r}) not in ('', 'NA')))" for r, c in _TEN[2:]) + "))"])
_ROW = ", ".join(f"r.{r}" for r, _ in _TEN)
sql("wildcard_lookup", f"""
grouped as (select {', '.join(c for _, c in _TEN)}, case when count(cash_flow_type) > 1 then 'Q' else min(cash_flow_type) end as v from lk group by all),
choice as (select *, count(*) over (partition by evnt_typ_cd, trnsctn_cls) = 1 as alone,
  {' + '.join(f"coalesce(cast({c} = '-' as int), 0)" for _, c in _TEN[2:])} as wild from grouped),
fit as (select {_ROW}, c.v, c.wild, c.alone is not null as fits from (select distinct * from rws) r left join choice c on {_FITS}),
best as (select *, row_number() over (partition by {', '.join(r for r, _ in _TEN)} order by not fits, wild, (v = 'Q') nulls first, v nulls first) as n from fit)
select {_ROW}, case when v = 'Q' then null else coalesce(v, '@') end as cash_flow_type,
 case when v = 'Q' then 'Cash flow type ambiguous for event type code (' || coalesce(r.event_type_code, '') || ') and transaction class (' || coalesce(r.transaction_class, '') || ');' end as error_message,
 count(*) as rows from rws r join best b on n = 1 and {' and '.join(f'r.{r} is not distinct from b.{r}' for r, _ in _TEN)} group by all""",
    f"lk as ({q.WILDCARD_LOOKUP}), rws as ({q.WILDCARD_ROWS}),")
sql("attribute_rules", f"select rn, {_attributes_sql()} from src", f"src as ({q.RULE_ROWS}) ")
sql("ambiguous_lookup", "select p_brand, cast(p_size as bigint) as p_size, case when count(nullif(p_type, 'PROMO BURNISHED COPPER')) > 1 then 'Q' else min(nullif(p_type, 'PROMO BURNISHED COPPER')) end as p_type from part group by 1, 2")
sql("orders_with_lines", f"select {_ORDERS} from orders o where exists (select 1 from lineitem where l_orderkey = o.o_orderkey)")
sql("orders_without_lines", f"select {_ORDERS} from orders o where not exists (select 1 from lineitem where l_orderkey = o.o_orderkey)")
sql("comma_list", """select value, count(*) as rows from (select trim(unnest(string_split(p_brand || ', ' || p_type || ',,' || p_name, ','))) as value from part) where value <> '' group by 1""")

sql("classify_headers", """select transaction_date, gl_reversal_date, gl_application_area_code, gl_source_code, secondary_ledger_code, orig_gl_center, data_type,
 txn as transaction_number_drvd, hard as hard_error_message, soft as soft_error_message, flag_out as reprocess_flag, outcome as error_cleared from hfinal""", HEADERS)
sql("transaction_forced", "select outcome as error_cleared, flag_out as reprocess_flag, hard as hard_error_message, soft as soft_error_message, count(*) as rows from hforced group by all", FORCED_HEADERS)
_FINAL = f"""select distinct '2025-12-08 08:30:15' as recorded_timestamp, 'core' as source_system_name, cast(null as varchar) as original_cycle_date, cast(null as varchar) as original_batch_id,
 txn as transaction_number, sys as source_system_nm, ledger as ledger_name, evt as event_type_code, sub as subledger_short_name, cast(tdate as varchar) as transaction_date,
 cast(rdate as varchar) as gl_reversal_date, gl_application_area_code, src as gl_source_code, ldg as secondary_ledger_code, data_type,
 '2025-12-05' as cycle_date, cast(700042 as bigint) as batch_id from hforced where outcome = 'Good'"""
sql("final_headers", _FINAL, FORCED_HEADERS)
sql("classify_lines", """select orig_gl_source_document_id, gl_full_source_code, secondary_ledger_code, orig_gl_account, amount as default_amount_drvd, debit_credit_indicator,
 txn as transaction_number, cast(line_number as varchar) as line_number, hard as hard_error_message, soft as soft_error_message, outcome as error_cleared from lfinal""", LINES)
sql("classify_lines_summary", """select outcome as error_cleared, gl_application_area_code, src as gl_source_code_drvd, count(*) as rows,
 cast(sum(cast(amount as decimal(18,2))) as double) as amount, cast(max(line_number) as varchar) as last_line from lfinal group by 1, 2, 3""", LINES)
_LINE_TABLE = f"""select 'core' as source_system_name, txn as transaction_number, line_number, amount as default_amount, debit_credit_indicator, gl_full_source_code,
 orig_gl_source_document_id, orig_gl_company, orig_gl_account, orig_gl_center, orig_gl_description_1, orig_gl_description_2, orig_gl_description_3, orig_gl_project_code,
 {', '.join(_REINS_COLUMNS)}, {_attributes_sql()}, '2025-12-05' as cycle_date, cast(700042 as bigint) as batch_id from lforced where outcome = 'Good'"""
sql("line_attributes", _LINE_TABLE, LINES_FORCED)
sql("accounting_ids", "select count(*) as lines, count(*) as ids, count(*) as well_formed from lforced where outcome = 'Good'", LINES_FORCED)
sql("line_numbering", """select l_orderkey, l_extendedprice, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate,
 cast(row_number() over (partition by l_orderkey order by l_extendedprice, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) as bigint) as line_number from lineitem""")

sql("error_view", f"""select '2025-12-05' as original_cycle_date, cast(700042 as bigint) as original_batch_id, 'core' as source_system_name,
 'core_general_ledger_line_item' as table_name, case when outcome = 'Hard Error' then 'Hard' else 'Soft' end as error_classification_name,
 trim(hard || soft) as error_message, cast(0 as bigint) as error_record_aging_days, case when outcome = 'Hard Error' then 'N' else 'Y' end as reprocess_flag,
 {', '.join(errors.LINE_FIELDS)} from (select * exclude (hard, soft), case when any_rdm and not own_rdm then hard else hard end as hard,
   case when any_rdm and not own_rdm then '' else soft end as soft from lforced) where outcome <> 'Good'""", LINES_FORCED)
sql("error_records", f"""select case when outcome = 'Hard Error' then 'Hard' else 'Soft' end as error_classification_name, flag_out as reprocess_flag,
 cast(0 as bigint) as error_record_aging_days, {', '.join(errors.HEADER_FIELDS)}, ledger as ledger_name_drvd, cast(tdate as varchar) as transaction_date_drvd
 from hforced where outcome <> 'Good'""", FORCED_HEADERS)

_NEXT = _joined('s', 'flags', _HEADER_FLAG).replace("from subledgers", "from subledgers2").replace("join ledgers", "join ledgers2")
sql("reprocess_errors", f"""subledgers2 as ({w.COMPLETE_SUBLEDGER_SQL}),
 ledgers2 as ({w.COMPLETE_LEDGER_SQL}),
 s as (select transaction_date, gl_reversal_date, gl_application_area_code, gl_source_code, secondary_ledger_code, gl_full_source_code, orig_gl_center, data_type
  from hforced where outcome = 'Soft Error'),
 s1 as ({_NEXT}),
 s2 as (select *, max(case when flag = '@' then 1 else 0 end) over (partition by {_GRAIN}) as bad from s1
  where coalesce(s_flag,'Include') = 'Include' and coalesce(l_flag,'Include') = 'Include')
 select case when ledger is not null and sys is not null and evt is not null and sub is not null and bad = 0 then 'Good - Reprocessed Error' else 'Soft Error' end as error_cleared,
 src as gl_source_code_drvd, cast(700042 as bigint) as original_batch_id, count(*) as rows from s2 group by 1, 2""", FORCED_HEADERS + ",")

# A second batch: headers0 again and the soft errors of the first one, classified apart from each other.
_CHAIN = HEADERS[HEADERS.index("h1 as ("):]
_CHAIN = re.sub(r"\b(h[1-6]|keys|hpairs|hfinal|headers0)\b", r"n_\1", _CHAIN)
_CHAIN = _CHAIN.replace("from subledgers", "from subledgers2").replace("join ledgers", "join ledgers2")
_CHAIN = _CHAIN.replace(_ORDER, _ORDER + ", orig").replace(_GRAIN, _GRAIN + ", orig").replace(_SAME, _SAME + " and a.orig = b.orig").replace(
    "and src is not null\n  group by", "and src is not null and orig = 700043\n  group by").replace(
    "src = f_src)", "src = f_src and orig = 700043)")
sql("reprocessed_with_new", f"""subledgers2 as ({w.COMPLETE_SUBLEDGER_SQL}),
 ledgers2 as ({w.COMPLETE_LEDGER_SQL}),
 n_headers0 as (select *, cast(700043 as bigint) as orig from headers0 union all
  select transaction_date, gl_reversal_date, gl_application_area_code, gl_source_code, secondary_ledger_code, gl_full_source_code, orig_gl_center, data_type, 700042
  from hforced where outcome = 'Soft Error'),
 {_CHAIN}
 select transaction_date, gl_reversal_date, gl_application_area_code, gl_source_code, secondary_ledger_code, orig_gl_center, data_type, txn as transaction_number_drvd,
 hard as hard_error_message, soft as soft_error_message, case when outcome = 'Good' and orig = 700042 then 'Good - Reprocessed Error' else outcome end as error_cleared,
 orig as original_batch_id from n_hfinal""", FORCED_HEADERS + ",")


def _error_view_sql(table: str, columns: list[str], present: list[str]) -> str:
    """Open errors with all columns of their view; a forced row has the forced message once."""
    return f"""select '2025-12-08 08:30:15' as recorded_timestamp, '2025-12-05' as original_cycle_date, cast(700042 as bigint) as original_batch_id,
 '2025-12-08 08:30:15' as original_recorded_timestamp, 'core' as source_system_name, 'core_{table}' as table_name,
 case when outcome = 'Hard Error' then 'Hard' else 'Soft' end as error_classification_name,
 case when any_rdm and not own_rdm then msg || trim(substr(hard, length(msg) + 1) || substr(soft, length(msg) + 1)) else trim(hard || soft) end as error_message,
 cast(0 as bigint) as error_record_aging_days, case when outcome = 'Hard Error' then 'N' else 'Y' end as reprocess_flag,
 {', '.join(c if c in present else f'cast(null as varchar) as "{c}"' for c in columns)}, ledger as ledger_name_drvd, sys as source_system_nm_drvd"""


sql("header_error_view", _error_view_sql("general_ledger_header", HEADER_ERROR_VIEW, errors.HEADER_FIELDS) + " from hforced where outcome <> 'Good'", FORCED_HEADERS)
sql("line_error_view", _error_view_sql("general_ledger_line_item", LINE_ERROR_VIEW, errors.LINE_FIELDS) + " from lforced where outcome <> 'Good'", LINES_FORCED)
sql("aged_pairs", """select s as source_system_name, cast(sum(h) as bigint) as aged_headers, cast(sum(l) as bigint) as aged_lines, cast((sum(h) > 0) = (sum(l) > 0) as varchar) as consistent from (
 select o_orderpriority as s, cast(o_orderstatus <> 'F' and datediff('day', cast(o_orderdate as date), date '2001-08-05') > 400 as int) as h, 0 as l from orders
 union all select o_orderpriority, 0, cast(l_linestatus <> 'F' and o_orderpriority not in ('2-HIGH', '5-LOW') and datediff('day', cast(l_shipdate as date), date '2001-08-05') > 400 as int)
 from lineitem join orders on l_orderkey = o_orderkey) group by 1""")

_AGE = "datediff('day', cast(o_orderdate as date), date '2001-08-05')"
_KIND = "case o_orderstatus when 'O' then 'Soft' when 'F' then 'Hard' else 'Cleared' end"
_MESSAGE = "case when o_orderstatus = 'P' then null else o_orderpriority end"
_MONTH = "year(o_orderdate) * 100 + month(o_orderdate)"
sql("age_soft_errors", f"""select case when {_AGE} > 400 then 'Hard/Aged Soft' else 'Soft' end as error_classification_name, o_orderpriority as error_message,
 case when {_AGE} > 400 then 'N' else 'Y' end as reprocess_flag, cast({_AGE} as bigint) as error_record_aging_days, cast(o_orderkey as varchar) as order_key,
 case when {_AGE} > 400 then '2001-08-05' end as cycle_date, case when {_AGE} > 400 then '200108' end as batch_id from orders where o_orderstatus = 'O'""")
_BACK = "(o_orderstatus = 'P' and cast(o_orderdate as date) = date '1998-06-15')"
sql("reinstate_processed", f"""select case when {_BACK} then 'Soft/Rerun' else {_KIND} end as error_classification_name,
 case when {_BACK} then 'was open ' || o_orderpriority else {_MESSAGE} end as error_message, case when {_BACK} or o_orderstatus = 'O' then 'Y' else 'R' end as reprocess_flag,
 cast(case when {_BACK} then 0 else {_AGE} end as bigint) as error_record_aging_days, cast(o_orderkey as varchar) as order_key,
 case when o_orderstatus = 'P' and not {_BACK} then cast(cast(o_orderdate as date) as varchar) end as cycle_date,
 case when o_orderstatus = 'P' and not {_BACK} then cast({_MONTH} as varchar) end as batch_id from orders where o_orderstatus in ('O', 'P')""")
_OWN = f"(cast(o_orderdate as date) = date '1998-06-15' and {_MONTH} = 199806)"
sql("reinstate_hard", f"""select 'Hard' as error_classification_name, o_orderpriority as error_message, 'N' as reprocess_flag, cast({_AGE} as bigint) as error_record_aging_days,
 cast(o_orderkey as varchar) as order_key, cast(null as varchar) as cycle_date from orders where o_orderstatus = 'F' and not {_OWN}
 union all select 'Soft', o_orderpriority, 'Y', {_AGE}, cast(o_orderkey as varchar), null from orders where o_orderstatus = 'O' and {_AGE} > 1500""")
sql("json_field_edits", f"""select {_KIND} as error_classification_name, {_MESSAGE} as error_message, case o_orderstatus when 'O' then 'Y' when 'F' then 'N' else 'R' end as reprocess_flag,
 cast({_AGE} as bigint) as error_record_aging_days, cast(o_orderkey as varchar) as order_key, 'ledger' as source, cast(null as varchar) as priority, o_orderpriority as urgency,
 'C' || cast(o_custkey as varchar) as customer from orders""")
sql("inferred_error_fields", f"select o_orderpriority as priority, case when o_orderstatus = 'P' then cast({_MONTH} as varchar) end as batch_id, count(*) as rows from orders group by 1, 2")
_TYPE = f"case when o_orderstatus = 'O' then 'RDM Lookup Missing' else 'Data Invalid from Source' end"
sql("error_summary", f"""select 'tpch_general_ledger_header' as table_name, cast(cast(o_orderdate as date) as varchar) as original_cycle_date, cast({_MONTH} as bigint) as original_batch_id,
 {_KIND} as error_classification_name, {_TYPE} as error_type, 'tpch' as source_system, count(*) as error_record_count from orders where o_orderstatus <> 'P' group by all""")
sql("missing_references", """select o_orderpriority as soft_error_message, cast(cast(o_orderdate as date) as varchar) as original_cycle_date, count(*) as error_record_count
 from orders where o_orderstatus = 'O' group by 1, 2""")
_XF = "XForced Error. Hard Errors"
sql("forced_error_counts", f"""select cast(0 as bigint) as forced_soft_rdm, cast(0 as bigint) as forced_hard_date, cast(sum(n) as bigint) as forced_hard_data, cast(sum(n) as bigint) as total_forced
 from (select cast(count(*) as bigint) as n from hforced where starts_with(hard, '{_XF}') union all select count(*) from lforced where starts_with(hard, '{_XF}'))""", LINES_FORCED)
sql("error_view_stats", """select '2025-12-05' as original_cycle_date, case when outcome = 'Hard Error' then 'Hard' else 'Soft' end as error_classification_name, 'core' as source_system_name,
 count(*) as cnt, '2025-12-08 08:30:15' as min_recorded_timestamp, '2025-12-08 08:30:15' as max_recorded_timestamp, '2025-12-05' as min_original_cycle_date,
 '2025-12-05' as max_original_cycle_date from lforced where outcome <> 'Good' group by 2""", LINES_FORCED)
sql("reprocessed_summary", """select cast(cast(o_orderdate as date) as varchar) as cycle_date, cast(1 as bigint) as batch_id,
 cast(cast(date_trunc('month', o_orderdate) - interval 1 month as date) as varchar) as original_cycle_date, cast(1 as bigint) as original_batch_id, o_orderstatus as ledger_name,
 count(distinct o_orderkey) as header_count, count(*) as line_count from orders left join lineitem on l_orderkey = o_orderkey where o_orderstatus <> 'F' group by all""")

# Changes and history.

sql("cdc_actions", """with old as (select * from orders where o_orderdate < date '1999-01-01' qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
new as (select * from orders where o_orderdate >= date '1999-01-01' qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select n.o_custkey, n.o_orderkey, n.o_orderstatus, n.o_orderpriority,
 case when o.o_orderstatus = n.o_orderstatus and o.o_orderpriority = n.o_orderpriority then 'UNCHANGED' else 'INSERT' end as cdc_action,
 '1999-01-01' as cycle_date, cast(2 as bigint) as batch_id from new n left join old o on n.o_custkey = o.o_custkey""")
sql("cdc_after_delete", """with old as (select * from orders where o_orderdate < date '1999-01-01' qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
new as (select * from orders where o_orderdate >= date '1999-01-01' qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select n.o_custkey, n.o_orderkey, case when n.o_custkey % 3 <> 0 and n.o_custkey % 5 <> 0 and o.o_orderstatus = n.o_orderstatus and o.o_orderpriority = n.o_orderpriority
 then 'UNCHANGED' else 'INSERT' end as cdc_action from new n left join old o on n.o_custkey = o.o_custkey""")
sql("delete_detection", """select distinct o_custkey as documentid, '1998-12-31' as pointofviewstopdate, cast(2 as bigint) as batch_id, 'orders' as domain_name, 'tpch' as source_system_name,
 'DAILY' as batch_frequency, '1999-01-01' as cycle_date from orders where o_orderdate < date '1999-01-01'
 and o_custkey not in (select o_custkey from orders where o_orderdate >= date '1999-01-01')""")
sql("coded_deletes", """select o_custkey as documentid, case when bool_or(o_orderstatus = 'P') then '1998-12-31' end as pointofviewstopdate,
 count(*) filter (o_orderstatus <> 'P') as kept from orders group by 1""")
sql("one_per_document", f"select {_ORDERS} from (select *, row_number() over (partition by o_custkey order by o_orderpriority, o_orderkey) as n from orders) where n = 1")
sql("dropped_copies", "select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) - 1 as dropped from lineitem group by 1, 2 having count(*) > 1")
sql("expired_contracts", """select 'P' || cast(c_custkey as varchar) as policy_no, c_custkey as policy_id, cast(3 as bigint) as batch_id, 'tpch' as source_system, 'orders' as domain_name,
 '1995-06-01' as cycle_date from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F' and o_orderdate < date '1995-06-01')""")

DAILY = """
daily as (select user_id, event_type, cast(ts as date) as d, cast(strftime(ts, '%Y%m%d') as bigint) as b from events
  qualify row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) = 1),
changes as (select * from daily qualify event_type is distinct from lag(event_type) over (partition by user_id order by d)),
versions as (select *, coalesce(lead(d) over (partition by user_id order by d) - 1, date '9999-12-31') as stop from changes),
first_changes as (select * from daily where d < date '2024-01-16' qualify event_type is distinct from lag(event_type) over (partition by user_id order by d)),
first_half as (select *, coalesce(lead(d) over (partition by user_id order by d) - 1, date '9999-12-31') as stop from first_changes),
w0 as (select user_id, event_type, d, date '9999-12-31' as stop, b, 'Staging' as s from daily where d >= date '2024-01-16'
  union all select user_id, event_type, d, stop, b, 'Target' from first_half where stop = date '9999-12-31'
   and user_id in (select user_id from daily where d >= date '2024-01-16')),
w1 as (select *, case when s = 'Target' then 'UPDATE' when event_type = lag(event_type) over (partition by user_id order by d, b) then 'UNCHANGED' else 'INSERT' end as a from w0),
w2 as (select *, coalesce(lead(d) over (partition by user_id order by d) - 1, date '9999-12-31') as new_stop from w1 where a <> 'UNCHANGED'),
working as (select user_id, event_type, d, new_stop as stop, b, s, case when s = 'Target' and new_stop = date '9999-12-31' then 'UNCHANGED' else a end as a from w2
  union all select user_id, event_type, d, stop, b, s, a from w1 where a = 'UNCHANGED')"""
_V = "user_id, event_type, cast(d as varchar) as pointofviewstartdate, cast(stop as varchar) as pointofviewstopdate, b as batchid"
sql("staging_hashes", """select user_id, sha256(cast(user_id as varchar)) as naturalkeyhashvalue, sha256(event_type) as hashvalue, cast(d as varchar) as pointofviewstartdate,
 '9999-12-31' as pointofviewstopdate, b as batchid from daily""", DAILY)
sql("scd2_working", f"select {_V}, a as actiontype, s as sourcetable from working", DAILY)
sql("scd2_history", f"select {_V} from versions", DAILY)
sql("scd2_expected", f"""hourly as (select user_id, event_type, cast(ts as date) as d, cast(strftime(ts, '%Y%m%d%H') as bigint) as b from events
  where cast(ts as date) >= date '2024-01-16' qualify row_number() over (partition by user_id, cast(ts as date), hour(ts) order by ts desc, event_id desc) = 1),
e0 as (select user_id, event_type, d, date '9999-12-31' as stop, b, 'Staging' as s from hourly
  union all select user_id, event_type, d, stop, b, 'Target' from first_half where stop = date '9999-12-31' and user_id in (select user_id from hourly)),
e1 as (select *, case when s = 'Target' then 'UPDATE' when event_type = lag(event_type) over (partition by user_id order by d, b) then 'UNCHANGED' else 'INSERT' end as own from e0),
e2 as (select *, count(*) over (partition by user_id, d) as n, lag(own) over (partition by user_id, d order by b) as before from e1),
e3 as (select *, case when n > 2 and own <> 'UNCHANGED' and before = own then 'UNCHANGED' else own end as marked from e2),
e4 as (select *, coalesce(lead(d) over (partition by user_id order by d, b) - 1, date '9999-12-31') as ends from e3 where marked <> 'UNCHANGED')
select user_id, event_type, cast(d as varchar) as pointofviewstartdate, cast(ends as varchar) as pointofviewstopdate, b as batchid,
 case when s = 'Target' and ends = date '9999-12-31' then 'UNCHANGED' else marked end as actiontype, s as sourcetable from e4
union all select user_id, event_type, cast(d as varchar), cast(stop as varchar), b, marked, s from e3 where marked = 'UNCHANGED'""", DAILY + ",")
sql("scd2_deletes", """select user_id, event_type, cast(d as varchar) as pointofviewstartdate, cast(case when stop = date '9999-12-31'
  and user_id in (select user_id from versions where event_type = 'error') then date '2024-02-15' else stop end as varchar) as pointofviewstopdate, b as batchid from versions""", DAILY)
sql("compacted_history", """gone as (select *, case when stop = date '9999-12-31' and user_id in (select user_id from versions where event_type = 'error')
  then date '2024-02-15' else stop end as ends from versions)
 select user_id, event_type, cast(d as varchar) as pointofviewstartdate, cast(case when ends = date '9999-12-31' and event_type = 'click' then date '2024-02-20' else ends end as varchar)
  as pointofviewstopdate, b as batchid from gone""", DAILY + ",")
sql("history_loads", """l as (select *, case when d <= date '2024-01-10' then 20240110 when d <= date '2024-01-20' then 20240120 else 20240231 end as batch from daily),
 c as (select user_id, d, case when d <= date '2024-01-10' then 20240110 when d <= date '2024-01-20' then 20240120 else 20240231 end as batch from changes),
 e as (select batch, count(*) as versions, count(distinct user_id) filter (user_id in (select x.user_id from c x where x.batch < c.batch)) as closures from c group by 1)
 select 'load' as kind, cast(batch as bigint) as batch, cast(max(d) as varchar) as cycle, max(b) as newest, any_value(versions) as versions, any_value(closures) as closures
 from l join e using (batch) group by batch""", DAILY + ",")
_REPLAY = [("Total Count", "recordcount", None, "count(*)"), ("DistinctCount", "event_type", None, "count(distinct event_type)"),
           ("Sum Total", "user_id", None, "sum(user_id)"), ("Sum Total on Year", "pointofviewstartdate", None, "sum(year(start))"),
           ("Count grouped by distinct value", None, "event_type", "count(*)")]
sql("replay_balance", f"""select batchid, cast(cycledate as varchar) as cycledate, operation, 'users_' || coalesce(f, g) as control_id, f as fact_col_name, g as group_col_name, v as group_col_val,
 {", ".join(f"cast(coalesce(sum(n) filter (tag = '{t}'), 0) as double) as {t.lower()}_value" for t in ("S", "T", "SA", "TA", "SI"))},
 cast(0 as double) as variance, cast(0 as double) as ended_variance, 'Y' as is_match from m group by all""", DAILY + """,
tagged as (select case when a = 'INSERT' then 'S' else 'SI' end as tag, b as batchid, d as cycledate, user_id, event_type, d as start from working where s = 'Staging'
  union all select 'SA', cast(strftime(stop + 1, '%Y%m%d') as bigint), stop + 1, user_id, event_type, d from working where a = 'UPDATE'
  union all select 'T', b, d, user_id, event_type, d from versions where d >= date '2024-01-16'
  union all select 'TA', cast(strftime(stop + 1, '%Y%m%d') as bigint), stop + 1, user_id, event_type, d from versions
   where d < date '2024-01-16' and stop >= date '2024-01-15' and stop < date '9999-12-31'),
m as (""" + " union all ".join(
    f"select tag, batchid, cycledate, '{op}' as operation, {repr(f) if f else 'cast(null as varchar)'} as f, {repr(g) if g else 'cast(null as varchar)'} as g, "
    f"{g or 'cast(null as varchar)'} as v, {agg} as n from tagged group by all" for op, f, g, agg in _REPLAY) + ")")
sql("deleted_parents", """select user_id as documentid, '2024-02-15' as pointofviewstopdate from versions group by 1 having bool_or(event_type = 'click')""", DAILY)
sql("closed_by_batch", f"""select cast(strftime(stop + 1, '%Y%m%d') as bigint) as closing_batch, {_V}
 from working where a = 'UPDATE' and stop + 1 in (select d from daily)""", DAILY)
sql("lookup_asof", """select event_id, e.user_id, v.event_type as version from events e left join versions v on e.user_id = v.user_id and cast(e.ts as date) between v.d and v.stop""", DAILY)
sql("scd2_intraday", """with hourly as (select user_id, event_type, cast(ts as date) as d, cast(strftime(ts, '%Y%m%d') as bigint) * 100 + hour(ts) as b from events
  qualify row_number() over (partition by user_id, cast(ts as date), hour(ts) order by ts desc, event_id desc) = 1),
 h1 as (select *, case when event_type = lag(event_type) over (partition by user_id order by d, b) then 'UNCHANGED' else 'INSERT' end as a from hourly),
 h2 as (select *, coalesce(cast(lead(d) over (partition by user_id order by b) as timestamp) - interval 1 minute, timestamp '9999-12-31') as stop,
   count(*) over (partition by user_id, d) as n, row_number() over (partition by user_id, d order by b) as r from h1 where a = 'INSERT'),
 h3 as (select user_id, event_type, b, a, case when n > 1 then cast(d as timestamp) + to_minutes(30 * (r - 1)) else cast(d as timestamp) end as start,
   case when n > 1 and stop <> timestamp '9999-12-31' then cast(d as timestamp) + to_minutes(30 * (r - 1) + 29) else stop end as stop from h2
   union all select user_id, event_type, b, a, cast(d as timestamp), timestamp '9999-12-31' from h1 where a = 'UNCHANGED')
 select user_id, event_type, strftime(start, '%Y-%m-%d %H:%M:%S') as pointofviewstartdate, strftime(stop, '%Y-%m-%d %H:%M:%S') as pointofviewstopdate, b as batchid, a as actiontype from h3""")
sql("append_history", """select case when o_orderstatus = 'P' then -o_orderkey else o_orderkey end as o_orderkey, o_orderstatus, cast(strftime(o_orderdate, '%Y%m') as bigint) as batchid from orders""")
sql("touched_documents", """with touched as (select o_orderkey as k from orders where strftime(o_orderdate, '%Y%m') = '199806'
  union select l_orderkey from lineitem where strftime(l_shipdate, '%Y%m') = '199806'
  union select l_orderkey from lineitem where l_shipdate <= timestamp '1998-06-30 00:00:00' and l_suppkey in (select s_suppkey from supplier where 199800 + s_suppkey % 40 = 199806))
 select o_orderkey as documentid, cast(strftime(o_orderdate, '%Y%m') as bigint) as batchid, cast(199806 as bigint) as for_batch from orders
 where cast(o_orderdate as date) <= date '1998-06-30' and o_orderkey in (select k from touched)""")

sql("touched_by_batches", """with days as (select last_day(cast(o_orderdate as date)) as c, cast(strftime(o_orderdate, '%Y%m') as bigint) as b, o_orderpriority as s from orders
  where (year(o_orderdate) * 12 + month(o_orderdate)) % 17 = 5 and o_orderpriority <> '3-MEDIUM' group by all),
 con as (select o_orderkey as k, cast(strftime(o_orderdate, '%Y%m') as bigint) as b, o_orderpriority as s, cast(o_orderdate as date) as f,
  case when o_orderkey % 3 = 0 then date '9999-12-31' else cast(o_orderdate as date) + cast(90 + o_custkey % 400 as int) end as t from orders),
 lnk as (select l_orderkey as k, l_suppkey as p, cast(strftime(l_shipdate, '%Y%m') as bigint) as b, o_orderpriority as s, l_linenumber < 3 as pri, cast(l_shipdate as date) as f,
  cast(l_shipdate as date) + cast(30 * l_linenumber as int) as t from lineitem join orders on l_orderkey = o_orderkey),
 par as (select distinct s_suppkey as p, 199401 + 100 * (s_suppkey % 6) + s_suppkey % 12 as b, o_orderpriority as s from supplier join orders on s_suppkey % 50 = o_custkey % 50),
 touched as (select k from con join days using (b, s) union select k from lnk join days using (b, s)
  union select k from lnk join days on lnk.s = days.s and c between f and t where pri and p in (select p from par join days using (b, s)))
 select k as documentid, con.b as batchid, days.b as for_batch, con.s as source_system_name from con join days on con.s = days.s and c between f and t where k in (select k from touched)""", "")
sql("catalogue_by_system", f"""with cat as (select distinct * from ({q.CATALOGUE}) where is_active = 'Y'),
 rws as (select *, case when l_returnflag = 'R' then 'returns' else 'sales' end as domain_name, l_linestatus as source_system_name, year(l_shipdate) as yr from lineitem),
 met as (select r.*, c.measure_type as op, c.measure_field as f, case c.measure_field when 'l_suppkey' then cast(l_suppkey as varchar) when 'l_linenumber' then cast(l_linenumber as varchar)
  when 'l_returnflag' then l_returnflag end as txt from rws r join cat c using (domain_name, source_system_name))
 select domain_name, source_system_name, yr as year, op as operation, domain_name || '_' || f as control_id, case when op <> 'Count grouped by distinct value' then f end as fact_col_name,
  case when op = 'Count grouped by distinct value' then f end as group_col_name, case when op = 'Count grouped by distinct value' then txt end as group_col_val,
  cast(case when op in ('Total Count', 'Count grouped by distinct value') then count(*) when op = 'DistinctCount' then count(distinct txt)
   when op = 'Sum Total' then case when f = 'l_quantity' then sum(l_quantity) else 0 end else sum(year(l_shipdate)) end as double) as fact_val
 from met group by domain_name, source_system_name, yr, op, f, case when op = 'Count grouped by distinct value' then txt end""")
sql("error_report_by_source", f"""select 'tpch_general_ledger_header' as table_name, cast(cast(o_orderdate as date) as varchar) as original_cycle_date, cast({_MONTH} as bigint) as original_batch_id,
 {_KIND} as error_classification_name, {_TYPE} as error_type, '1-URGENT' as source_system, count(*) as error_record_count from orders where o_orderstatus <> 'P'
 and cast(o_orderdate as date) in (select cast(o_orderdate as date) from orders where o_orderpriority = '1-URGENT' and o_custkey % 2 = 0 and o_orderkey % 3 <> 0) group by all""")

# Batches.

TRACK = f"""tracking as ({q.TRACKING}), done as (select * from tracking where load_status = 'complete'),
bases as (select distinct source_system_name, domain_name from tracking where domain_name <> 'dom3'),
used as (select source_system_name, domain_name, max(cycle_date) as c, max(batch_id) as b from tracking where cycle_date <= date '2024-01-10' group by 1, 2),
pending as (select distinct d.source_system_name, d.domain_name, d.batch_id, d.cycle_date, phase_name, load_status from done d join bases using (source_system_name, domain_name)
  left join used u using (source_system_name, domain_name) where cycle_date >= date '2024-01-05' and (c is null or cycle_date > c or batch_id > b)),
ranked as (select *, dense_rank() over (partition by source_system_name, cycle_date order by batch_id) as rnk from pending),
runs as (select cycle_date, rnk, row_number() over (partition by cycle_date order by rnk) as seq from (select distinct cycle_date, rnk from ranked)),
last as (select distinct cycle_date, 421 as n from tracking where cycle_date <= date '2024-01-16'),
derived as (select distinct cast(strftime(r.cycle_date, '%Y%m%d') || '00042' || cast(case when n is null then 0 else 1 end + seq as varchar) as bigint) as batch_id, r.cycle_date,
  p.source_system_name as base_source_system_name, p.domain_name as base_domain_name, p.batch_id as base_batch_id
  from runs r left join last l on r.cycle_date = l.cycle_date join ranked p on p.cycle_date = r.cycle_date and p.rnk = r.rnk)"""
sql("finished_batches", """select source_system_name, domain_name, batch_id, event_id from (select *, row_number() over (partition by source_system_name, domain_name, batch_id
 order by insert_timestamp desc, event_id desc) as n from tracking) where n = 1 and load_status = 'complete'""", TRACK)
sql("current_batches", "select source_system_name, domain_name, batch_id, cast(cycle_date as varchar) as cycle_date, phase_name, load_status, rnk from ranked", TRACK)
sql("batch_ids", """select 'hub' as source_system_name, 'derived' as domain_name, 'DAILY' as batch_frequency, batch_id, cast(cycle_date as varchar) as cycle_date,
 base_source_system_name, base_domain_name, base_batch_id from derived""", TRACK)
sql("last_completed", """select 'derived' as domain_name, 'hub' as source_system, 'DAILY' as batch_frequency,
 max(cast(strftime(cycle_date, '%Y%m%d') || '000421' as bigint)) as batch_id, cast(max(cycle_date) as varchar) as cycle_date from last""", TRACK)
sql("newly_completed", """select distinct batch_id, cast(cycle_date as varchar) as cycle_date, 'derived' as domain_name, 'hub' as source_system, 'DAILY' as batch_frequency
 from derived where day(cycle_date) >= 20""", TRACK)
sql("next_batch", """select 'derived' as domain_name, 'hub' as source_system, 'DAILY' as batch_frequency, min(batch_id) as batch_id, cast(min(cycle_date) as varchar) as cycle_date
 from derived where batch_id > (select max(batch_id) from derived where day(cycle_date) < 18)""", TRACK)
sql("ready_dates", """select source_system_name, cast(cycle_date as varchar) as cycle_date, count(distinct domain_name) as domains, max(batch_id) as last_batch
 from done join bases using (source_system_name, domain_name) join (select source_system_name, count(distinct domain_name) as needed from bases group by 1) using (source_system_name)
 where batch_id > 20240110 group by source_system_name, cycle_date, needed having count(distinct domain_name) = needed""", TRACK)
sql("batch_count_mismatches", """select source_system_name, cast(cycle_date as varchar) as cycle_date, count(distinct hour(insert_timestamp)) as actual_batch_count, cast(23 as bigint) as number_of_batches
 from tracking group by 1, 2 having count(distinct hour(insert_timestamp)) <> 23""", TRACK)
sql("base_coverage", """select cast(cycle_date as varchar) as cycle_date, string_agg(distinct source_system_name, ',' order by source_system_name) as source_systems,
 cast(count(distinct source_system_name || domain_name) = 6 as varchar) as is_complete from tracking where load_status = 'failed' and source_system_name in ('click','error','view')
 and domain_name in ('dom0','dom1') group by 1""", TRACK)
sql("overlapping_batches", """span as (select event_type, min(d) as c0, max(d) as c1, min(b) as b0, max(b) as b1 from daily where d < date '2024-01-16' group by 1)
 select distinct source_system_name, cast(cycle_date as varchar) as cycle_date, batch_id from tracking join span on source_system_name = event_type
 where cycle_date between c0 and c1 or batch_id between b0 and b1""", TRACK + "," + DAILY + ",")
sql("duplicate_runs", """select 'orders' as domain_name, o_orderpriority as source_system, 'DAILY' as batch_frequency, cast(cast(o_orderdate as date) as varchar) as cycle_date, count(*) as runs
 from orders group by o_orderpriority, cast(o_orderdate as date) having count(*) > 1""")
sql("calendar_flags", """with cycles as (select distinct cast(o_orderdate as date) as c, o_orderpriority as s from orders)
 select cast(c as varchar) as cycle_date, s as source_system_name, case when c = last_day(c) then 'Y' else 'N' end as monthend_flag,
 case when c <> last_day(c) and dayofweek(c) = 5 then 'Y' else 'N' end as weekend_flag, case when c = last_day(c) then cast(cast(date_trunc('month', c) - interval 1 day as date) as varchar) end as prev_monthend_date,
 case when c <> last_day(c) and dayofweek(c) = 5 then cast(c - 7 as varchar) end as prev_weekend_date, cast(year(c) - 2 as varchar) || '0101' as two_year_from_cycle_date, cast(year(c) - 7 as varchar) || '0101' as seven_year_from_cycle_date
 from cycles""")
sql("inforce_batch", """with m as (select o_orderpriority as s, o_orderkey as b, cast(o_orderdate as date) as d from orders where o_orderstatus = 'F'),
 cur as (select s, max(b) as b, max(d) as d from m where d <= date '1999-03-31' group by 1), prev as (select s, max(b) as b, max(d) as d from m where d <= date '1999-02-28' group by 1)
 select cur.s as source_system, case when month(cur.d) = 3 and cur.d <> date '1999-03-31' then prev.b else cur.b end as batch_id,
 cast(case when month(cur.d) = 3 and cur.d <> date '1999-03-31' then prev.d else cur.d end as varchar) as effective_date from cur left join prev using (s)""")
sql("second_daily_batch", """select o_orderpriority as source_system, o_orderkey as batch_id, cast(cast(o_orderdate as date) as varchar) as effective_date from orders
 where o_orderstatus <> 'F' and o_orderdate <= date '1999-03-31' qualify row_number() over (partition by o_orderpriority order by o_orderkey desc) = 2""")
sql("rerun_state", """select cast(bool_or(o_orderdate < date '1999-01-01' and cast(o_orderdate as date) = date '1998-06-15') as varchar) as is_rerun, cast(bool_or(o_orderdate > date '1998-06-15') as varchar) as is_backdated from orders""")

# Controls.


def _single(tag: str, where: str = "true", batch: str = "") -> str:
    by, group = (f"{batch} as batch, ", f" group by {batch}, {tag}") if batch else ("", "")
    rows = [("Total Count", "recordcount", "count(*)"), ("DistinctCount", "l_partkey", "count(distinct l_partkey)"),
            ("Sum Total", "l_extendedprice", "sum(cast(l_extendedprice as decimal(28,6)))"), ("Sum Total on Year", "l_shipdate", "sum(year(l_shipdate))")]
    return " union all ".join(
        f"select {by}{tag} as tag, '{op}' as operation, 'lines_{f}' as control_id, '{f}' as fact_col_name, cast(null as varchar) as group_col_name, "
        f"cast(null as varchar) as group_col_val, cast({agg} as double) as fact_val from lineitem where {where}{group}" for op, f, agg in rows)


def _grouped(tag: str, where: str = "true") -> str:
    base = "select {t} as tag, 'Count grouped by distinct value' as operation, 'lines_{i}' as control_id, cast(null as varchar) as fact_col_name, '{n}' as group_col_name, {v} as group_col_val, cast(count(*) as double) as fact_val from lineitem where {w} group by {v}"
    return base.format(t=tag, i="l_returnflag", n="l_returnflag", v="l_returnflag", w=where) + " union all " + base.format(
        t=tag, i="l_returnflag_l_linestatus", n="l_returnflag,l_linestatus", v="l_returnflag || '|' || l_linestatus", w=where)


sql("kc2_measures", _single("'S'") + " union all " + _grouped("'S'"))
sql("kc2_by_batch", _single("l_returnflag", batch="year(l_shipdate)"))
sql("kc2_compare", f"""select s.operation, s.control_id, s.fact_col_name, s.group_col_name, s.group_col_val, s.fact_val as source_fact_value, t.fact_val as target_fact_value,
 cast(cast(s.fact_val as decimal(28,2)) - cast(t.fact_val as decimal(28,2)) as double) as fact_value_variance, case when s.fact_val = t.fact_val then 'Y' else 'N' end as match_indicator from s join t on s.control_id = t.control_id
 and s.group_col_val is not distinct from t.group_col_val""",
    f"s as ({_single(chr(39) + 'S' + chr(39))} union all {_grouped(chr(39) + 'S' + chr(39))}), t as ({_single(chr(39) + 'T' + chr(39), 'l_quantity > 1')} union all {_grouped(chr(39) + 'T' + chr(39), 'l_quantity > 1')})")
sql("catalogue_measures", """select 'Total Count' as operation, 'recordcount' as fact_col_name, cast(count(*) as double) as fact_val from lineitem
 union all select 'DistinctCount', 'l_suppkey', count(distinct l_suppkey) from lineitem union all select 'Sum Total', 'l_quantity', sum(l_quantity) from lineitem
 union all select 'Sum Total on Year', 'l_shipdate', sum(year(l_shipdate)) from lineitem""")
_LOGSQL = LINES_FORCED + f""",
lx as ({_joined('lines0', 'reins', _LINE_FLAGS)}),
tagged as (select 'S' as tag, data_type, case when {_CENTS} > 0 then {_CENTS} else 0 end as c from lines0
 union all select 'SA', data_type, case when {_CENTS} > 0 then {_CENTS} else 0 end from lx where coalesce(s_flag,'') = 'Exclude' or coalesce(l_flag,'') = 'Exclude'
 union all select 'SI', data_type, case when {_CENTS} > 0 then {_CENTS} else 0 end from lforced where outcome <> 'Good'
 union all select 'T', data_type, case when {_CENTS} > 0 then {_CENTS} else 0 end from lforced where outcome = 'Good'),
measured as (select tag, 'Total Count' as operation, 'recordcount' as f, cast(null as varchar) as g, cast(null as varchar) as v, cast(count(*) as double) as n from tagged group by tag
 union all select tag, 'Sum Total', 'default_amount', null, null, cast(sum(c) as double) / 100 from tagged group by tag
 union all select tag, 'Count grouped by distinct value', null, 'data_type', data_type, count(*) from tagged group by tag, data_type)"""
sql("balance_lines", """select operation, 'general_ledger_line_item_' || coalesce(f, g) as control_id, f as fact_col_name, g as group_col_name, v as group_col_val,
 coalesce(sum(n) filter (tag = 'S'), 0) as s_value, coalesce(sum(n) filter (tag = 'T'), 0) as t_value, coalesce(sum(n) filter (tag = 'SA'), 0) as sa_value,
 coalesce(sum(n) filter (tag = 'SI'), 0) as si_value, cast(0 as double) as ti_value, cast(0 as double) as ta_value, cast(0 as double) as variance, 'Y' as is_match
 from measured group by all""", _LOGSQL)
_HLOG = FORCED_HEADERS + f""",
hx as ({_joined('headers0', 'flags', _HEADER_FLAG)}),
htagged as (select 'S' as tag, data_type from headers0
 union all select 'SA', data_type from hx where coalesce(s_flag,'') = 'Exclude' or coalesce(l_flag,'') = 'Exclude'
 union all select 'SI', data_type from hforced where outcome <> 'Good'
 union all select 'T', data_type from (select distinct txn, data_type from hforced where outcome = 'Good')
 union all select 'TI', data_type from (select data_type, row_number() over (partition by txn) as n from hforced where outcome = 'Good') where n > 1),
hmeasured as (select tag, 'Total Count' as operation, 'recordcount' as f, cast(null as varchar) as g, cast(null as varchar) as v, cast(count(*) as double) as n from htagged group by tag
 union all select tag, 'Count grouped by distinct value', null, 'data_type', data_type, count(*) from htagged group by tag, data_type)"""
sql("balance_headers", """select operation, 'general_ledger_header_' || coalesce(f, g) as control_id, f as fact_col_name, g as group_col_name, v as group_col_val,
 coalesce(sum(n) filter (tag = 'S'), 0) as s_value, coalesce(sum(n) filter (tag = 'T'), 0) as t_value, coalesce(sum(n) filter (tag = 'SA'), 0) as sa_value,
 coalesce(sum(n) filter (tag = 'SI'), 0) as si_value, coalesce(sum(n) filter (tag = 'TI'), 0) as ti_value, cast(0 as double) as ta_value, cast(0 as double) as variance, 'Y' as is_match
 from hmeasured group by all""", _HLOG)
sql("control_log", """select 'lines' as domain, 'tpch' as sys_nm, 'CONTROL_TOTAL' as measure_name, 'l_quantity' as measure_field, cast(year(l_shipdate) as bigint) as batch_id,
 cast(cast(l_shipdate as date) as varchar) as cycle_date, sum(l_quantity) as measure_value, 'INTEGER' as measure_value_datatype from lineitem
 where cast(l_shipdate as date) in (select cast(o_orderdate as date) from orders where o_orderstatus = 'F') group by year(l_shipdate), cast(l_shipdate as date)""")
sql("adjustments", """select operation, f as fact_col_name, v as group_col_val, 'ADJ S' as side, cast(-sum(cast(n as decimal(28,2))) as double) as adjustment from measured where tag in ('SA', 'SI') group by 1, 2, 3""", _LOGSQL)
_WB = [("Total Count", "recordcount", "count(*)"), ("DistinctCount", "l_partkey", "count(distinct l_partkey)"),
       ("Sum Total", "l_extendedprice", "sum(cast(l_extendedprice as decimal(28,2)))"), ("Sum Total on Year", "l_shipdate", "sum(year(l_shipdate))")]
sql("warehouse_balance", " union all ".join(f"""select '{op}' as operation, '{f}' as fact_col_name, cast({a} as double) as src_measure_value, cast({a} as double) as tgt_measure_value,
 cast({a} filter (l_returnflag = 'R') as double) as tgt_adj_measure_value, cast({a} filter (l_returnflag = 'A') - {a} filter (l_returnflag = 'R') as double) as variance,
 case when {a} filter (l_returnflag = 'A') = {a} filter (l_returnflag = 'R') + {a} filter (l_returnflag = 'N') then 'Y' else 'N' end as is_match from lineitem""" for op, f, a in _WB))
sql("row_identity", """select count(*) as source_rows, count(*) filter (outcome = 'Soft Error') as soft_rows, count(*) filter (outcome = 'Hard Error') as hard_rows, cast(0 as bigint) as cleared_rows,
 count(*) filter (outcome = 'Good') as good_rows, 'Y' as holds from lforced""", LINES_FORCED)
sql("control_totals", """select cast(sum(cast(strftime(l_shipdate, '%Y%m%d') as bigint)) as double) as measure_value, 'l_shipdate' as field from lineitem
 union all select cast(sum(l_orderkey) as double), 'l_orderkey' from lineitem""")
sql("additional_control", "select 'MATCHING' as count_check, case when count(*) filter (l_linenumber = 7) = 0 then 'MATCHING' else 'NOT MATCHING' end as sum_check from lineitem")
sql("collapsed_copies", "select cast(count(*) - count(distinct cast(l_orderkey as varchar) || l_returnflag || l_linestatus) as bigint) as measure_value from lineitem")
_LI = "l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate"
sql("duplicates", f"select {_LI} from (select *, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) where n > 1")
sql("headers_without_lines", "select o_orderkey as k from orders except select l_orderkey from lineitem")
sql("header_count_check", """select h as headers, l as line_headers, case when h = l then 'Y' else 'N' end as is_match from (select (select count(*) from orders) as h, (select count(distinct l_orderkey) from lineitem) as l)""")
sql("forced_good_rows", f"""d as (select *, not tchk or not rchk or early as dated from (select *, {_DERIVED} from lines0)),
 pairs as (select gl_application_area_code as a, src as s from d where gl_application_area_code is not null and src is not null group by 1, 2 having bool_or(dated) and bool_or(not dated))
 select gl_application_area_code, src as gl_source_code_drvd, count(*) as rows from d join pairs on gl_application_area_code = a and src = s where not dated group by 1, 2""", BASE + ",")

# Reshaping and the rest.

sql("eav_transpose", """with e as (select cast(user_id as varchar) as naturalkey, cast(ts as date) as ld, case when event_id % 2 = 0 then 'amount' else 'label' end as c,
  case event_type when 'view' then 3 when 'click' then 2 else 1 end as p, case when event_type = 'view' and event_id % 3 = 0 then '' else 'v' || cast(event_id % 1000 as varchar) end as v from events),
 g as (select naturalkey, ld, c, p, max(v) as v from e group by 1, 2, 3, 4),
 b as (select * from g qualify row_number() over (partition by naturalkey, ld, c order by p desc) = 1)
 select naturalkey, cast(ld as varchar) as load_date, nullif(max(v) filter (c = 'amount'), '') as amount, nullif(max(v) filter (c = 'label'), '') as label from b group by 1, 2""")
sql("eav_record_count", "select cast(d as varchar) as load_date, count(*) as record_count from (select distinct cast(ts as date) as d, user_id, event_type from events) group by d")
sql("pairs_to_columns", """select o_orderkey, o_orderstatus, case when o_orderkey % 3 = 0 then 'C' || cast(o_custkey as varchar) end as contract_no,
 case when o_orderkey % 3 = 1 then 'C' || cast(o_custkey as varchar) end as "45_contract_no",
 case when o_orderkey % 2 = 0 then 'old_contract_no=X' || cast(o_custkey as varchar) else '' end as other_pairs from orders""")
sql("pivot_pairs", """select o_orderkey, case when o_orderkey % 3 = 0 then 'C' || cast(o_custkey as varchar) end as contract_no,
 case when o_orderkey % 3 = 1 then 'C' || cast(o_custkey as varchar) end as "45_contract_no",
 case when o_orderkey % 2 = 0 then 'X' || cast(o_custkey as varchar) end as old_contract_no,
 case when o_orderkey % 2 = 1 then 'X' || cast(o_custkey as varchar) end as other from orders""")
sql("header_line_join", """select o_orderkey as transaction_number, cast(l_linenumber as bigint) as l_linenumber, o_orderstatus as header_status, l_linestatus as line_status, o_totalprice as header_amount,
 l_extendedprice as line_amount, l_partkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate from orders join lineitem on l_orderkey = o_orderkey""")
sql("combined_window", """select o_orderkey, case when o_orderstatus <> 'F' then o_orderstatus end as o_orderstatus, case when o_orderstatus <> 'P' then o_orderpriority end as o_orderpriority,
 cast(cast(o_orderdate as date) as varchar) as cycle_date, case o_orderstatus when 'O' then 'open' when 'P' then 'partial' else 'finished' end as source_table
 from orders where cast(o_orderdate as date) between date '1999-03-01' and date '1999-03-31'""")
_VIEW = {"cycledate": "cycle_date", "batchid": "batch_id"}
_PRESENT = """transaction_number secondary_ledger_code ledger_name subledger_short_name event_type_code source_system_nm data_type transaction_date
 gl_application_area_code gl_reversal_date gl_source_code source_system_name cycledate batchid original_cycle_date original_batch_id""".split()
sql("current_view", "select " + ", ".join(
    f"{_VIEW.get(c, c)} as {c}" if c in _PRESENT else f"cast(null as varchar) as {c}" for c in HEADER_VIEW if c not in ("inserttimestamp", "updatetimestamp"))
    + f" from ({_FINAL})", FORCED_HEADERS)
_LINE_PRESENT = """source_system_name transaction_number line_number default_amount debit_credit_indicator gl_full_source_code
 orig_gl_source_document_id orig_gl_company orig_gl_account orig_gl_center orig_gl_description_1 orig_gl_description_2 orig_gl_description_3 orig_gl_project_code""".split()
_LINE_PRESENT += [*_REINS_COLUMNS, *_ATTRIBUTES]
sql("current_line_view", "select " + ", ".join(
    f"{_VIEW[c]} as {c}" if c in _VIEW else c if c in _LINE_PRESENT else f'cast(null as varchar) as "{c}"'
    for c in LINE_VIEW if c not in ("inserttimestamp", "updatetimestamp", "activity_accounting_id")) + f" from ({_LINE_TABLE})", LINES_FORCED)
_TREE = f"tree as ({q.TREE}), "
sql("hierarchy_levels", """walk as (select name, parent, summary, allow_posting, cycle_date, 1 as level, [description_us] as p from tree where parent is null
  union all select t.name, t.parent, t.summary, t.allow_posting, t.cycle_date, w.level + 1, list_append(w.p, t.description_us) from tree t join walk w on t.parent = w.name)
 select name, parent, summary, cast(allow_posting as bigint) as allow_posting, cast(cycle_date as bigint) as cycle_date, cast(level as bigint) as level,
 """ + ", ".join(f"p[{i}] as level_{i}" for i in range(1, 29)) + " from walk", "recursive " + _TREE)
sql("leaves_below", """walk as (select * from tree where description_us = 'ASIA' union select t.* from tree t join walk w on t.parent = w.name)
 select name, parent, description_us, cast(cycle_date as bigint) as cycle_date from walk where allow_posting = 1""", "recursive " + _TREE)
sql("row_hashes", """select o_orderkey, sha256(o_orderstatus || '|' || o_orderpriority) as header_hash, sha256(cast(o_custkey as varchar) || '|' || cast(o_orderkey as varchar)) as line_hash from orders""")
_LINE_HASH = "sha256(concat_ws('|', {}))"
sql("pattern_hashes", f"""select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, sha256(concat_ws('|', o_orderkey, o_orderstatus)) as header_hash,
 case when o_orderpriority in ('1-URGENT', '2-HIGH') then {_LINE_HASH.format("l_linenumber, l_returnflag, l_linestatus, l_partkey")}
  when o_orderpriority = '3-MEDIUM' then {_LINE_HASH.format("l_linenumber, l_returnflag, l_partkey")}
  else {_LINE_HASH.format("l_linenumber, l_returnflag, o_orderstatus, l_partkey")} end as line_hash from lineitem join orders on l_orderkey = o_orderkey""")
_UUID = "substr(h,1,8) || '-' || substr(h,9,4) || '-{v}' || substr(h,14,3) || '-' || translate(substr(h,17,1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h,18,3) || '-' || substr(h,21,12)"
sql("document_ids", f"""select c_custkey, (select {_UUID.format(v=3)} from (select md5(c_name) as h)) as uuid3,
 (select {_UUID.format(v=5)} from (select sha1(unhex('6ba7b8149dad11d180b400c04fd430c8') || encode(c_name)) as h)) as uuid5 from customer""")
sql("masked_names", "select c_custkey, c_name, 'true' as is_masked from customer")
_MONTHLY = f"m as ({q.MONTHLY}) "
sql("written_partitions", """select o_orderkey, case when month % 3 = 0 and month <> 199606 then 'X' else status end as status, month from m
 where month <> 199505 and (month <> 199606 or status = 'F')""", _MONTHLY)
sql("truncated_and_loaded", "select * from m where status = 'F'", _MONTHLY)
sql("error_backup", "select o_orderkey, 'lines' as table_name, 'O' as reprocess_flag from orders where o_orderkey % 3 <> 0 and o_orderstatus = 'O'")
sql("reconciled_columns", """select o_orderkey, 'o_custkey,o_orderpriority,o_orderstatus,o_totalprice' as of_header, cast(null as varchar) as l_extendedprice,
 cast(null as varchar) as l_linenumber, cast(null as varchar) as l_linestatus, cast(null as varchar) as l_partkey, cast(null as varchar) as l_quantity,
 cast(null as varchar) as l_returnflag, cast(null as varchar) as l_shipdate, cast(null as varchar) as l_suppkey from orders""")
sql("load_states", """select 'new' as state, count(*) as versions from first_half union all select 'loaded', count(*) from versions
 union all select 'partial', count(*) from versions where user_id % 2 = 0""", DAILY)
sql("completed_batches", f"""select 'completed' as kind, source_system, batch_id from r where batch_id % 4 = 0
 union all select 'unfinished', source_system, batch_id from r where batch_id % 2 = 1""", f"r as ({q.RUNS}) ")
sql("incomplete_rows", """select o_orderkey, case when o_orderstatus = 'F' then 'Good' else 'Unknown outcome' end as error_cleared from orders
 where (o_orderstatus = 'F' and o_custkey % 4 = 0) or o_orderstatus not in ('F', 'O')""")
sql("repaired_markers", """select o_orderkey, case when marked then 'Cleared' when o_orderkey % 2 = 0 then 'Soft/Rerun' else 'Soft' end as error_classification_name,
 case when not marked then o_orderpriority end as error_message, case when marked then 'R' when o_orderstatus = 'O' then 'Y' else 'N' end as reprocess_flag
 from (select *, o_orderstatus = 'O' and o_orderkey % 2 = 0 as marked from orders)""")
