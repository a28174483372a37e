"""Deterministic keys: row hashes, accounting ids, name-based UUIDs, masking."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the X.500 namespace of RFC 4122.
X500_NAMESPACE = "6ba7b8149dad11d180b400c04fd430c8"


def joined(columns: Iterable[str], separator: str = "|", nulls: bool = False) -> Column:
    """Columns as one text that no other columns give.

    Separators and backslashes inside a column are escaped. A null becomes ''
    so that it keeps its position, or with ``nulls`` a mark that no text gives.
    """
    def one(c: str) -> Column:
        text = F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        text = F.replace(text, F.lit(separator), F.lit("\\" + separator))
        return F.coalesce(text, F.lit("\\N" if nulls else ""))

    return F.concat_ws(separator, *[one(c) for c in columns])


def row_hash(columns: Iterable[str], separator: str = "|", nulls: bool = False) -> Column:
    return F.sha2(joined(columns, separator, nulls), 256)


@dataclass(frozen=True)
class HashPattern:
    """How lines of some source systems are hashed.

    The code that only some systems fill comes from the ``line``, from the
    ``header``, or there is ``none``, and then it is not hashed.
    """

    systems: tuple[str, ...]
    code_from: str = "line"


def pattern_of(patterns: dict[str, HashPattern], system: str) -> str:
    """The pattern a source system belongs to: there must be exactly one."""
    found = sorted(name for name, p in patterns.items() if system in p.systems)
    if len(found) != 1:
        raise ValueError(f"source system {system!r} is in {'no pattern' if not found else ', '.join(found)}")
    return found[0]


def pattern_hashes(
    rows: DataFrame, system: str, patterns: dict[str, HashPattern], header: list[str], line: list[str], code: str,
    header_code: str, ignored: Iterable[str] = (),
) -> DataFrame:
    """Rows of any systems with ``header_hash`` and ``line_hash``, the columns chosen by the system's pattern.

    Every pattern is an expression over the same row, so all systems are hashed
    in one pass. A row of a system without a pattern stops the job.
    """
    for name in sorted({s for p in patterns.values() for s in p.systems}):
        pattern_of(patterns, name)
    kept = [c for c in line if c not in set(ignored)]
    columns = {"line": kept, "none": [c for c in kept if c != code],
               "header": [header_code if c == code else c for c in kept]}
    chosen = F.raise_error(F.concat(F.lit("no pattern for source system "), F.coalesce(F.col(system), F.lit("null"))))
    for p in patterns.values():
        chosen = F.when(F.col(system).isin(*p.systems), row_hash(columns[p.code_from])).otherwise(chosen)
    return rows.withColumns({
        "header_hash": row_hash([c for c in header if c not in set(ignored)]), "line_hash": chosen})


def header_key(columns: list[str], complete: Column, spread: Column) -> Column:
    """Bytes that stand for a header in joins and windows.

    Rows without a complete header get bytes of their own instead: they match
    nothing, and the rows do not all meet in one task as they would under null.
    """
    own = F.concat(F.lit("-"), spread.cast("string")).cast("binary")
    return F.when(complete, F.unhex(F.md5(joined(columns)))).otherwise(own)


def accounting_id(columns: list[str], run_ts: datetime, outbound: bool, part: Column | None = None) -> Column:
    """Run date, outbound digit, sign digit and twenty hash digits as one text.

    ``part`` numbers rows that agree in every hashed column.
    """
    part = F.lit(1) if part is None else part
    value = F.xxhash64(F.concat_ws("|", part.cast("string"), joined(columns)))
    digits = F.lpad(F.abs(value.cast("decimal(20,0)")).cast("string"), 20, "0")
    sign = F.when(value < 0, "0").otherwise("1")
    return F.concat(F.lit(run_ts.strftime("%Y%m%d") + ("1" if outbound else "0")), sign, digits)


def _uuid(digest: Column, version: str) -> Column:
    # The variant digit keeps the two low bits of the original one.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-" + version),
        F.substring(digest, 14, 3), F.lit("-"), variant,
        F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def uuid3(name: Column | str) -> Column:
    """Version 3 UUID of a text in the empty namespace; null and '' stay as they are."""
    name = F.col(name) if isinstance(name, str) else name
    return F.when(name == "", name).otherwise(_uuid(F.md5(F.encode(name, "UTF-8")), "3"))


def uuid5(name: Column | str) -> Column:
    """Version 5 UUID of a text in the X.500 namespace; null and '' stay as they are."""
    name = F.col(name) if isinstance(name, str) else name
    payload = F.concat(F.unhex(F.lit(X500_NAMESPACE)), F.encode(name, "UTF-8"))
    return F.when(name == "", name).otherwise(_uuid(F.sha1(payload), "5"))


def mask(c: Column | str, key: Column) -> Column:
    """Encrypt a text column to hex; blank values become null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > 0, F.hex(F.aes_encrypt(c, key)))


def unmask(c: Column | str, key: Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > 0, F.aes_decrypt(F.unhex(c), key).cast("string"))
