"""Reconciliation: counts, control totals and grouped measures per hop.

A measure table has one row per measure, tag and group. Tags say where a
value was taken: ``S`` source, ``T`` target, ``SA`` source rows left out,
``SI`` source rows in error, ``TI`` target duplicates, ``TA`` target rows that
come from earlier batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbook.functions import codes
from quillbook.session import control_table

TAGS = ["S", "T", "SA", "SI", "TI", "TA"]
# The old name of a tag, and the tags that lower the target.
TAG_ALIASES = {"A": "SA"}
NEGATIVE = ("SA", "SI", "TI")

# Measure types of the control catalogue.
TOTAL_COUNT = "Total Count"
DISTINCT_COUNT = "DistinctCount"
SUM_TOTAL = "Sum Total"
SUM_YEAR = "Sum Total on Year"
GROUPED_COUNT = "Count grouped by distinct value"

VALUE = "decimal(38,6)"
GROUP = "_group"
ENTRY = "struct<text:string,number:decimal(28,6),year:bigint>"


@dataclass(frozen=True)
class Measure:
    """One line of the control catalogue."""

    kind: str
    field: str = "recordcount"
    policy: str | None = None  # amount policy for text amounts
    pattern: str | None = None  # date pattern for text dates

    @property
    def fields(self) -> list[str]:
        return [f.strip() for f in self.field.split(",")]

    def control_id(self, domain: str) -> str:
        return f"{domain}_{self.field.replace(',', '_').replace('.', '_')}"

    def aggregate(self) -> Column:
        if self.kind == TOTAL_COUNT:
            value = F.count(F.lit(1))
        elif self.kind == DISTINCT_COUNT:
            value = F.countDistinct(self.field)
        elif self.kind == SUM_TOTAL:
            amount = codes.amount(self.field, self.policy) if self.policy else F.col(self.field).cast("decimal(28,6)")
            value = F.sum(amount)
        elif self.kind == SUM_YEAR:
            year = codes.year_of(self.field, self.pattern) if self.pattern else F.year(self.field)
            value = F.sum(year.cast("bigint"))
        else:
            raise ValueError(f"{self.kind!r} has no single value")
        return F.coalesce(value.cast(VALUE), F.lit(0).cast(VALUE))

    def group_value(self) -> Column:
        if len(self.fields) == 1:
            return F.col(self.fields[0]).cast("string")
        return F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in self.fields])


def from_catalogue(catalogue: DataFrame, domain: str, source_system: str) -> list[Measure]:
    """The active measures of a domain. The catalogue is configuration: a few rows."""
    rows = catalogue.where(
        (F.col("is_active") == "Y") & (F.col("domain_name") == domain)
        & (F.col("source_system_name") == source_system)
    ).select("measure_type", "measure_field").distinct().collect()
    return sorted((Measure(r["measure_type"], r["measure_field"]) for r in rows), key=lambda m: (m.kind, m.field))


def measure(
    rows: DataFrame, measures: list[Measure], tag: Column | str, domain: str, hop: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """All measures of a hop in long form.

    Single-value measures share one aggregation over ``rows``, whatever their
    number; grouped counts share a second one, over one row per measure.
    ``by`` adds columns such as batch and cycle date to every result.
    """
    tag = F.lit(tag) if isinstance(tag, str) else tag
    parts = []
    single = [m for m in measures if m.kind != GROUPED_COUNT]
    grouped = [m for m in measures if m.kind == GROUPED_COUNT]
    keys = [*by, "tag"]
    tagged = rows.withColumn("tag", tag)
    if single:
        values = tagged.groupBy(*keys).agg(*[m.aggregate().alias(f"_m{i}") for i, m in enumerate(single)])
        listed = F.explode(F.array(*[
            F.struct(
                F.lit(m.kind).alias("operation"), F.lit(m.control_id(domain)).alias("control_id"),
                F.lit(m.field).alias("fact_col_name"), F.lit(None).cast("string").alias("group_col_name"),
                F.lit(None).cast("string").alias("group_col_val"), F.col(f"_m{i}").alias("fact_val"))
            for i, m in enumerate(single)
        ]))
        parts.append(values.select(*keys, listed.alias("m")).select(*keys, "m.*"))
    if grouped:
        entries = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), m.group_value().alias("v")) for i, m in enumerate(grouped)]))
        counted = tagged.select(*keys, entries.alias(GROUP)).groupBy(
            *keys, F.col(f"{GROUP}.i").alias("i"), F.col(f"{GROUP}.v").alias("group_col_val"),
        ).agg(F.count(F.lit(1)).cast(VALUE).alias("fact_val"))

        def named(pick) -> Column:
            return F.element_at(F.array(*[F.lit(pick(m)) for m in grouped]), F.col("i") + 1)

        parts.append(counted.select(
            *keys, F.lit(GROUPED_COUNT).alias("operation"), named(lambda m: m.control_id(domain)).alias("control_id"),
            F.lit(None).cast("string").alias("fact_col_name"), named(lambda m: m.field).alias("group_col_name"),
            "group_col_val", "fact_val"))
    log = reduce(DataFrame.unionByName, parts)
    return log.withColumns({"domain": F.lit(domain), "hop_name": F.lit(hop)})


def measure_by_catalogue(rows: DataFrame, catalogue: DataFrame, fields: list[str], tag: Column | str, hop: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The active measures of all domains and systems in one pass; the catalogue stays a table.

    ``rows`` and ``catalogue`` have ``domain_name`` and ``source_system_name``.
    Each row meets the measures of its domain and system as one array, takes
    the fields that these name and no others, and goes into one aggregation by
    measure. Fields that are not among ``fields`` are measured as null: counts
    and sums of them are zero. ``recordcount`` counts rows.
    """
    keys = ["domain_name", "source_system_name"]
    active = catalogue.where(F.col("is_active") == "Y").select(*keys, "measure_type", "measure_field").distinct()
    listed = control_table(active.groupBy(*keys).agg(F.collect_set(F.struct("measure_type", "measure_field")).alias("_measures")))
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def entry(f: str) -> Column:
        number = F.col(f).cast("decimal(28,6)") if isinstance(kinds[f], T.NumericType) else F.lit(None).cast("decimal(28,6)")
        year = F.year(f) if isinstance(kinds[f], (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.lit(None).cast("int")
        return F.struct(F.col(f).cast("string").alias("text"), number.alias("number"), year.cast("bigint").alias("year")).cast(ENTRY)

    values = F.create_map(*[x for f in fields for x in (F.lit(f), entry(f))])
    tag = F.lit(tag) if isinstance(tag, str) else tag
    met = rows.withColumn("tag", tag).join(listed, keys).select(*keys, *by, "tag", values.alias("_values"), F.explode("_measures").alias("_m"))
    of = F.try_element_at("_values", F.col("_m.measure_field"))
    met = met.select(*keys, *by, "tag", F.col("_m.measure_type").alias("operation"), F.col("_m.measure_field").alias("field"),
                     of["text"].alias("_text"), of["number"].alias("_number"), of["year"].alias("_year"))
    is_group = F.col("operation") == GROUPED_COUNT
    found = met.withColumn("group_col_val", F.when(is_group, F.col("_text"))).groupBy(*keys, *by, "tag", "operation", "field", "group_col_val").agg(
        F.count(F.lit(1)).alias("_count"), F.sum("_number").alias("_sum"), F.sum("_year").alias("_years"),
        F.countDistinct(F.when(F.col("operation") == DISTINCT_COUNT, F.col("_text"))).alias("_distinct"))
    value = (F.when(F.col("operation").isin(TOTAL_COUNT, GROUPED_COUNT), F.col("_count").cast(VALUE))
             .when(F.col("operation") == DISTINCT_COUNT, F.col("_distinct").cast(VALUE))
             .when(F.col("operation") == SUM_TOTAL, F.col("_sum").cast(VALUE))
             .when(F.col("operation") == SUM_YEAR, F.col("_years").cast(VALUE)))
    return found.select(
        *keys, *by, "tag", "operation",
        F.concat_ws("_", "domain_name", F.translate("field", ",.", "__")).alias("control_id"),
        F.when(~is_group, F.col("field")).alias("fact_col_name"), F.when(is_group, F.col("field")).alias("group_col_name"), "group_col_val",
        F.coalesce(value, F.lit(0).cast(VALUE)).alias("fact_val"), F.lit(hop).alias("hop_name"))


def measure_copies(
    rows: DataFrame, keys: list[str], measures: list[Measure], domain: str, hop: str
) -> DataFrame:
    """Measures of the rows beyond one per key, tagged ``TI``: all rows less one row per key.

    Both terms are plain aggregates, so a key with very many copies is reduced
    before it is shuffled. The measured fields must depend on the keys.
    """
    every = measure(rows, measures, "TI", domain, hop)
    fields = [f for m in measures for f in m.fields if f in rows.columns]
    one = measure(rows.select(*dict.fromkeys([*keys, *fields])).distinct(), measures, "TI", domain, hop)
    return every.unionByName(one.withColumn("fact_val", -F.col("fact_val")))


def control_total(rows: DataFrame, field: str, datatype: str = "INTEGER") -> DataFrame:
    """Sum of a number column, or of dates as yyyyMMdd numbers."""
    if datatype == "DATE":
        value = F.date_format(F.col(field).cast("date"), "yyyyMMdd").cast("bigint")
    elif datatype == "INTEGER":
        value = F.col(field)
    else:
        raise ValueError(f"no control total for {datatype!r}")
    return rows.agg(F.coalesce(F.sum(value).cast(VALUE), F.lit(0).cast(VALUE)).alias("measure_value"))


def by_tag(log: DataFrame, keys: list[str], value: str = "fact_val") -> DataFrame:
    """One row per measure with a column per tag. Null keys match each other."""
    tag = reduce(lambda c, a: F.when(F.col("tag") == a, TAG_ALIASES[a]).otherwise(c), TAG_ALIASES, F.col("tag"))
    return log.withColumn("tag", tag).groupBy(*keys).pivot("tag", TAGS).agg(F.sum(value))


def _value(tag: str) -> Column:
    return F.coalesce(F.col(tag), F.lit(0).cast(VALUE))


def balance(log: DataFrame, keys: list[str], value: str = "fact_val") -> DataFrame:
    """Curated hop: target against source less what was left out plus what came back.

    A measure that one side lacks counts as zero there.
    """
    wide = by_tag(log, keys, value)
    expected = _value("S") - _value("SA") - _value("SI") - _value("TI") + _value("TA")
    variance = _value("T") - expected
    return wide.select(
        *keys, *[_value(t).alias(f"{t.lower()}_value") for t in TAGS],
        variance.alias("variance"), F.when(variance == 0, "Y").otherwise("N").alias("is_match"))


def warehouse_balance(log: DataFrame, keys: list[str], value: str = "fact_val") -> DataFrame:
    """Warehouse hop: signed adjustments on both sides, ignored source rows in the match."""
    wide = by_tag(log, keys, value)
    left, right = _value("S") + _value("SA"), _value("T") + _value("TA")
    return wide.select(
        *keys, _value("S").alias("src_measure_value"), _value("T").alias("tgt_measure_value"),
        _value("TA").alias("tgt_adj_measure_value"), (left - right).alias("variance"),
        F.when(left == right + _value("SI"), "Y").otherwise("N").alias("is_match"))


def replay_balance(log: DataFrame, keys: list[str], value: str = "fact_val") -> DataFrame:
    """New versions (S) against those in history (T), ended ones (SA) against theirs (TA); rows left alone (SI) besides.

    Both have to agree by themselves, as not every measure can be added up.
    """
    wide = by_tag(log, keys, value)
    new, ended = _value("S") - _value("T"), _value("SA") - _value("TA")
    return wide.select(
        *keys, *[_value(t).alias(f"{t.lower()}_value") for t in ("S", "T", "SA", "TA", "SI")], new.alias("variance"),
        ended.alias("ended_variance"), F.when((new == 0) & (ended == 0), "Y").otherwise("N").alias("is_match"))


def adjustments(log: DataFrame, keys: list[str], value: str = "fact_val") -> DataFrame:
    """Signed sum of the adjustment rows of each side."""
    sign = F.when(F.col("tag").isin(*NEGATIVE, *TAG_ALIASES), -1).otherwise(1)
    side = F.concat(F.lit("ADJ "), F.when(F.col("tag").isin("TI", "TA"), "T").otherwise("S"))
    rows = log.where(~F.col("tag").isin("S", "T"))
    return rows.groupBy(*keys, side.alias("side")).agg(F.sum(sign * F.col(value)).alias("adjustment"))


def key_results(
    source: DataFrame, target: DataFrame, keys: list[str], nullable: tuple[str, ...] = ("fact_col_name", "group_col_name", "group_col_val")
) -> DataFrame:
    """Source and target measures side by side; null group columns match each other."""
    s = source.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.col("fact_val").alias("s_val"))
    t = target.select(*[F.col(k).alias(f"t_{k}") for k in keys], F.col("fact_val").alias("t_val"))

    def same(k: str) -> Column:
        left, right = s[f"s_{k}"], t[f"t_{k}"]
        # An equality on both sides keeps the full outer join a hash join.
        return F.coalesce(left, F.lit("")) == F.coalesce(right, F.lit("")) if k in nullable else left == right

    joined = s.join(t, reduce(lambda a, b: a & b, [same(k) for k in keys]), "full_outer")
    zero = F.lit(0).cast(VALUE)
    variance = F.coalesce("s_val", zero) - F.coalesce("t_val", zero)
    return joined.select(
        *[F.coalesce(f"s_{k}", f"t_{k}").alias(k) for k in keys],
        F.coalesce("s_val", zero).alias("source_fact_value"), F.coalesce("t_val", zero).alias("target_fact_value"),
        variance.alias("fact_value_variance"), F.when(variance == 0, "Y").otherwise("N").alias("match_indicator"))


def additional_control(source: DataFrame, target: DataFrame, amount: str) -> DataFrame:
    """Count and sum flags: ``MATCHING``, ``NOT MATCHING`` or ``EMPTY``."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("side"), F.col(amount).cast("decimal(28,6)").alias("amount"))

    both = side(source, "S").unionByName(side(target, "T"))
    of = {n: F.col("side") == n for n in ("S", "T")}
    sums = both.agg(
        *[F.count_if(c).alias(f"{n}_count") for n, c in of.items()],
        *[F.coalesce(F.sum(F.when(c, F.col("amount"))), F.lit(0)).alias(f"{n}_sum") for n, c in of.items()])

    def flag(kind: str) -> Column:
        empty = (F.col("S_count") == 0) & (F.col("T_count") == 0)
        same = F.col(f"S_{kind}") == F.col(f"T_{kind}")
        return F.when(empty, "EMPTY").when(same, "MATCHING").otherwise("NOT MATCHING")

    return sums.select(flag("count").alias("count_check"), flag("sum").alias("sum_check"))


def collapsed_copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows beyond one per key there are: what ``distinct`` will remove."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("measure_value"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def duplicate_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once; null keys are compared too."""
    dups = duplicate_keys(rows, keys).select(*[F.col(k).alias(f"_d_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(dups[f"_d_{k}"]) for k in keys])
    return rows.join(dups, on, "left_semi")


def headers_without_lines(headers: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    return headers.select(*keys).subtract(lines.select(*keys))


def header_count_check(headers: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Distinct headers among the lines against the headers loaded: one row."""
    tagged = headers.select(F.lit("H").alias("side"), F.col(key).alias("k")).unionByName(
        lines.select(F.lit("L").alias("side"), F.col(key).alias("k")))
    return tagged.agg(
        F.count_if(F.col("side") == "H").alias("headers"),
        F.countDistinct(F.when(F.col("side") == "L", F.col("k"))).alias("line_headers"),
    ).withColumn("is_match", F.when(F.col("headers") == F.col("line_headers"), "Y").otherwise("N"))


def incomplete_good_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without an outcome, and good rows whose natural key is not complete."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    outcome = F.col("error_cleared")
    return rows.where(outcome.startswith("Unknown") | (outcome.startswith("Good") & incomplete))


def row_identity(rows: DataFrame) -> DataFrame:
    """Classified rows against what becomes of them: one row.

    Good rows = all rows - (soft errors + hard errors). Cleared errors are good rows of earlier batches.
    """
    outcome = F.col("error_cleared")
    return rows.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(outcome == "Soft Error").alias("soft_rows"),
        F.count_if(outcome == "Hard Error").alias("hard_rows"),
        F.count_if(outcome == "Good - Reprocessed Error").alias("cleared_rows"),
        F.count_if(outcome.startswith("Good")).alias("good_rows"),
    ).withColumn("holds", F.when(
        F.col("good_rows") == F.col("source_rows") - F.col("soft_rows") - F.col("hard_rows"), "Y").otherwise("N"))


def forced_good_pairs(rows: DataFrame, good: Column, dated: Column, pair: list[str]) -> DataFrame:
    """Pairs that hold both a good row and a date error: their good rows are forced errors."""
    return rows.groupBy(*pair).agg(F.bool_or(good).alias("_g"), F.bool_or(dated).alias("_d")).where(
        F.col("_g") & F.col("_d")).select(*pair)


def error_rows(rows: DataFrame, good: Column, pairs: DataFrame, pair: list[str]) -> tuple[DataFrame, DataFrame]:
    """Own errors, and good rows forced into error by a sibling."""
    return rows.where(~good), rows.where(good).join(pairs, pair, "left_semi")


def log_entries(measured: DataFrame, batches: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Measured values as control log rows: named by the catalogue, for current batches only."""
    current = batches.select("batch_id", "cycle_date", F.col("source_system_name").alias("sys_nm")).distinct()
    known = catalogue.select("domain", "sys_nm", "measure_name", "measure_field", "measure_value_datatype").distinct()
    return measured.join(current, ["batch_id", "cycle_date", "sys_nm"]).join(
        known, ["domain", "sys_nm", "measure_name", "measure_field"])


def require_matches(results: DataFrame, flag: str = "is_match") -> None:
    bad = results.where(F.col(flag) != "Y").count()
    if bad:
        raise ValueError(f"{bad} control measures do not match")
