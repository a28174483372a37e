"""Column expressions for raw ledger fields: codes, Julian dates, amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the raw extracts.
DEBIT_CODES = ("10", "13", "DR")
CREDIT_CODES = ("60", "63", "CR")
REINSURED_PREFIXES = ("903", "851", "444")
MISSING = "@"
AMBIGUOUS = "Q"
WILDCARD = "-"

AMOUNT_POLICIES = (
    "ignore_negative",
    "get_precision",
    "ignore_precision",
    "decimal_precision",
    "absolute_precision",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_only(c: Column | str) -> Column:
    """Drop every character outside ASCII."""
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


def source_prefix(code: Column | str) -> Column:
    """First three characters of a source code; null if short or holding a space."""
    head = F.substring(_col(code), 1, 3)
    return F.when((F.length(head) == 3) & ~F.contains(head, F.lit(" ")), head)


def ledger_suffix(code: Column | str) -> Column:
    """Characters three and four of a company code; null if either is missing."""
    tail = F.substring(_col(code), 3, 2)
    return F.when(F.length(F.trim(tail)) == 2, tail)


def data_type(account: Column | str) -> Column:
    account = _col(account)
    statistical = account.startswith("9") & ~account.startswith("99")
    return F.when(statistical, "Statistical").otherwise("Financial")


def debit_credit(code: Column | str) -> Column:
    code = _col(code)
    return F.when(code.isin(*DEBIT_CODES), "Debit").when(code.isin(*CREDIT_CODES), "Credit")


def julian_date(text: Column | str) -> Column:
    """``yyyyDDD`` text as a date, null when it is not a real day.

    Plain integer arithmetic: no formatter and no exception per bad row.
    """
    text = _col(text)
    digits = F.when(text.rlike("^[0-9]{7}$"), text)
    year = F.substring(digits, 1, 4).cast("int")
    day = F.substring(digits, 5, 3).cast("int")
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    in_year = (year >= 1) & (day >= 1) & (day <= F.when(leap, 366).otherwise(365))
    return F.when(in_year, F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1))


def is_blank_or_zero(text: Column | str) -> Column:
    """True for null, empty and all-zero text: the ways a date is left out."""
    text = _col(text)
    return text.isNull() | text.rlike("^0*$")


def is_julian(text: Column | str, optional: bool = False) -> Column:
    """Julian date check; an ``optional`` date may be null, blank or zero."""
    valid = julian_date(text).isNotNull()
    return is_blank_or_zero(text) | valid if optional else valid


def is_date(text: Column | str, pattern: str, optional: bool = False) -> Column:
    """Date check for any other pattern of the Spark formatter."""
    text = _col(text)
    valid = F.try_to_date(text, pattern).isNotNull()
    return is_blank_or_zero(text) | valid if optional else F.coalesce(valid, F.lit(False))


def number(text: Column | str, kind: str) -> Column:
    """Text as a number of a type, null when it is none.

    Text without any digit is told by that: the cast makes an exception of every text it refuses.
    """
    text = _col(text)
    return F.when(text.rlike("[0-9]"), text.try_cast(kind))


def cents(text: Column | str) -> Column:
    """Amount text as whole cents; zero when null, blank or not a number."""
    return F.coalesce(number(text, "decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def amount(text: Column | str, policy: str = "ignore_negative") -> Column:
    """Amount text as decimal(18,2) under one of the ``AMOUNT_POLICIES``."""
    if policy == "ignore_negative":
        value = F.when(cents(text) > 0, cents(text) / 100).otherwise(F.lit(0))
    elif policy == "get_precision":
        value = cents(text) / 100
    elif policy == "ignore_precision":
        value = cents(text)
    elif policy == "decimal_precision":
        value = _col(text).try_cast("decimal(18,2)")
    elif policy == "absolute_precision":
        value = F.abs(F.coalesce(_col(text).try_cast("decimal(18,2)"), F.lit(0)))
    else:
        raise ValueError(f"unknown amount policy {policy!r}, expected one of {AMOUNT_POLICIES}")
    return F.coalesce(value.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))


def year_of(text: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Year of date text as a number, taken from where the pattern puts it."""
    text = _col(text)
    if pattern.startswith("yyyy"):
        year = F.substring(text, 1, 4)
    elif pattern.endswith("yyyy"):
        year = F.right(text, F.lit(4))
    elif pattern.startswith("yy"):
        year = F.concat(F.lit("20"), F.substring(text, 1, 2))
    else:
        raise ValueError(f"no year position known for pattern {pattern!r}")
    return year.try_cast("bigint")


def reinsurance(prefix_of: Column | str, attribute: Column | str) -> Column:
    """A reinsurance attribute: only for reinsured prefixes, ``@`` when missing."""
    prefix = F.substring(_col(prefix_of), 1, 3)
    return F.when(prefix.isin(*REINSURED_PREFIXES), F.coalesce(_col(attribute), F.lit(MISSING)))
