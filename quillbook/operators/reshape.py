"""Long to wide, header to line, and schema reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Precedence of entries of one attribute, strongest first.
PRECEDENCE = ("override", "transform", "source")


def stacked_pairs(df: DataFrame, keep: list[str], prefix: str = "gr") -> DataFrame:
    """``<prefix>*_name`` / ``<prefix>*_value`` column pairs as rows."""
    names = sorted(c for c in df.columns if c.startswith(prefix) and c.endswith("_name"))
    values = sorted(c for c in df.columns if c.startswith(prefix) and c.endswith("_value"))
    pairs = [
        F.struct(F.col(n).cast("string").alias("key"), F.col(v).cast("string").alias("value"))
        for n, v in zip(names, values)
    ]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("_pair")).select(*keep, "_pair.*")


def normal_key(key: str = "key") -> Column:
    """Lower-case key without the numbering in front of it (``101-CONTRACT_NO``)."""
    key_column = F.col(key)
    after = F.expr(f"substring({key}, instr({key}, '-') + 1)")
    return F.lower(F.when(F.substring(key_column, 4, 1) == "-", after).otherwise(key_column))


def _names(pairs: DataFrame, key: str) -> list[str]:
    """The keys met, in order: the columns of the result, so their number is that of a table's columns."""
    return sorted(r[0] for r in pairs.select(key).where(F.col(key).isNotNull()).distinct().collect())


def pairs_to_columns(
    df: DataFrame, row_id: list[str], wanted: list[str] | None = None, key_suffix: str | None = None, prefix: str = "gr"
) -> DataFrame:
    """Name/value column pairs as one column per key, other columns kept.

    Without ``wanted`` every key that occurs becomes a column. With it, the
    pairs of all other keys come out in ``other_pairs``, a map of key and
    value, so none is lost. The pairs of a row stay in that row: no join or
    shuffle. With several values for a key the largest is taken, as in a pivot.
    """
    names = sorted(c for c in df.columns if c.startswith(prefix) and c.endswith("_name"))
    values = sorted(c for c in df.columns if c.startswith(prefix) and c.endswith("_value"))

    def normalised(c: str) -> Column:
        return F.when(F.endswith(F.col(c), F.lit(key_suffix)), normal_key(c)) if key_suffix else normal_key(c)

    listed = wanted
    if listed is None:
        listed = _names(df.select(F.explode(F.array(*[normalised(n) for n in names])).alias("key")), "key")

    def value_of(key: str) -> Column:
        found = [F.when(normalised(n) == key, F.col(v).cast("string")) for n, v in zip(names, values, strict=True)]
        return F.greatest(*found) if len(found) > 1 else found[0]

    kept = [c for c in df.columns if c not in names and c not in values and c not in row_id]
    columns = [*row_id, *kept, *[value_of(k).alias(k) for k in listed]]
    if wanted is None:
        return df.select(*columns)
    # Pairs in order of key and value; of equal keys the last, largest value stays.
    pairs = F.filter(
        F.array(*[F.struct(normalised(n).alias("k"), F.col(v).cast("string").alias("v"))
                  for n, v in zip(names, values, strict=True)]),
        lambda p: p["k"].isNotNull() & ~p["k"].isin(*wanted))
    ordered = F.array_sort(pairs)
    last = F.filter(ordered, lambda p, i: ~F.get(ordered, i + 1)["k"].eqNullSafe(p["k"]))
    return df.select(*columns, F.map_from_entries(last).alias("other_pairs"))


def pivot_pairs(pairs: DataFrame, keep: list[str], wanted: list[str] | None = None) -> DataFrame:
    """Key/value rows as one column per key, one row for every ``keep``.

    Without ``wanted`` every key that occurs becomes a column.
    """
    listed = _names(pairs, "key") if wanted is None else wanted
    return pairs.groupBy(*keep).agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in listed])


def transposed(
    entries: DataFrame, keys: list[str], attributes: list[str], name: str, kind: str, value: str
) -> DataFrame:
    """Attribute rows as columns; an override beats a transform beats the source."""
    def entry(attribute: str, wanted: str) -> Column:
        return F.max(F.when((F.lower(name) == attribute) & (F.lower(kind) == wanted), F.col(value)))

    return entries.groupBy(*keys).agg(*[
        F.nullif(F.coalesce(*[entry(a, k) for k in PRECEDENCE]), F.lit("")).alias(a) for a in attributes
    ])


def entity_count(entries: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Distinct entities per batch, whatever number of attribute rows each has."""
    return entries.select(*dict.fromkeys([*by, *keys])).distinct().groupBy(*by).agg(
        F.count(F.lit(1)).alias("record_count"))


def header_line_join(headers: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Headers with their lines; other common columns get a prefix on each side."""
    missing = [k for k in keys if k not in headers.columns or k not in lines.columns]
    if missing:
        raise ValueError(f"join keys missing: {missing}")
    common = (set(headers.columns) & set(lines.columns)) - set(keys)

    def renamed(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c in common})

    return renamed(headers, "header").join(renamed(lines, "line"), keys)


def only_in(first: list[str], second: list[str], ignore: tuple[str, ...] = ()) -> list[str]:
    """Columns of the first table that the second lacks, in their order."""
    return [c for c in first if c not in second and c not in ignore]


def schema_differences(
    header: DataFrame, line: DataFrame, derived: tuple[str, ...] = ()
) -> tuple[list[str], list[str]]:
    """Header columns a line lacks, and line columns a header lacks."""
    return (only_in(header.columns, line.columns, derived), only_in(line.columns, header.columns, derived))


def with_missing(df: DataFrame, names: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Absent columns added as null text."""
    return df.withColumns({
        n: F.lit(None).cast("string") for n in names if n not in df.columns and n not in ignore})
