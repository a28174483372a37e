"""Which batches to run next, their numbers, and whether they are complete."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbook.operators.lookups import ranked
from quillbook.sources.extracts import latest, nth_latest

DOMAIN = ["domain_name", "source_system", "batch_frequency"]


def finished(tracking: DataFrame, phase: str) -> DataFrame:
    """The last state of each batch in a phase, where that state is complete."""
    own = tracking.where(F.col("phase_name") == phase)
    last = latest(own, ["source_system_name", "domain_name", "batch_id"], ["insert_timestamp"])
    return last.where(F.col("load_status") == "complete")


def last_finished(tracking: DataFrame, phase: str) -> DataFrame:
    """The newest finished batch of each source and domain."""
    done = tracking.where((F.col("phase_name") == phase) & (F.col("load_status") == "complete"))
    return latest(done, ["source_system_name", "domain_name"], ["batch_id", "insert_timestamp"])


def next_batch(current: DataFrame, done: DataFrame) -> DataFrame:
    """The oldest current batch of each domain above the last finished one."""
    last = done.groupBy("source_system", "domain_name").agg(F.max("batch_id").alias("_done"))
    open_batches = current.join(last, ["source_system", "domain_name"], "left").where(
        F.col("batch_id") > F.coalesce("_done", F.lit(0)))
    return open_batches.groupBy(*DOMAIN).agg(
        F.min("batch_id").alias("batch_id"), F.min("cycle_date").alias("cycle_date"))


def pending_base_batches(
    tracking: DataFrame, derived: DataFrame, bases: DataFrame, cut_off: date | None = None, per_day: bool = True
) -> DataFrame:
    """Finished warehouse batches of the base domains that no derived batch has used.

    ``bases`` lists source and domain, ``derived`` the base batches already
    used. Batches are ranked within a day, or by day where a domain has
    several batches per day.
    """
    used = derived.where(F.col("curated_load_complete_flag") == "Y")
    used = latest(
        used, ["base_source_system_name", "base_domain_name"],
        ["cycle_date", "base_batch_id", "insert_timestamp"],
    ).select(
        F.col("base_source_system_name").alias("source_system_name"), F.col("base_domain_name").alias("domain_name"),
        F.col("cycle_date").alias("_cycle"), F.col("base_batch_id").alias("_batch"))
    done = tracking.where((F.col("phase_name") == "datawarehouse") & (F.col("load_status") == "complete"))
    if cut_off is not None:
        done = done.where(F.col("cycle_date") >= F.lit(cut_off))
    columns = ["source_system_name", "domain_name", "batch_id", "cycle_date", "phase_name", "load_status"]
    open_batches = (
        done.select(*columns).distinct()
        .join(bases.select("source_system_name", "domain_name").distinct(), ["source_system_name", "domain_name"])
        .join(used, ["source_system_name", "domain_name"], "left")
        .where(F.col("_cycle").isNull() | (F.col("cycle_date") > F.col("_cycle")) | (F.col("batch_id") > F.col("_batch")))
        .select(*columns)
    )
    if per_day:
        return ranked(open_batches, ["source_system_name", "cycle_date"], ["batch_id"], "rnk")
    return ranked(open_batches, ["source_system_name"], ["cycle_date"], "rnk")


def last_completed(completed: DataFrame) -> DataFrame:
    return completed.groupBy(*DOMAIN).agg(
        F.coalesce(F.max("batch_id"), F.lit(0)).alias("batch_id"), F.max("cycle_date").alias("cycle_date"))


def derived_batch_ids(
    pending: DataFrame, completed: DataFrame, system_id: int, source_system: str, domain: str, frequency: str
) -> DataFrame:
    """Derived batches and the base batches each is built from.

    The number is the date, a five-digit system id and a sequence that goes on
    after the last completed number of the same date.
    """
    system = f"{system_id:05d}"
    day = F.date_format("cycle_date", "yyyyMMdd")
    runs = pending.select("cycle_date", "rnk").distinct()
    # One row per date and rank: a control table, whatever the size of the batches.
    runs = ranked(runs, ["cycle_date"], ["rnk"], "_sequence")
    own = completed.where(
        (F.col("source_system") == source_system) & (F.col("domain_name") == domain)
        & (F.col("batch_frequency") == frequency))
    last = own.groupBy("cycle_date").agg(F.max("batch_id").alias("_last"))
    sequence_so_far = F.replace(F.col("_last").cast("string"), F.concat(day, F.lit(system)), F.lit(""))
    sequence = F.coalesce(sequence_so_far.cast("bigint"), F.lit(0)) + F.col("_sequence")
    numbered = runs.join(last, "cycle_date", "left").select(
        "cycle_date", "rnk",
        F.concat(day, F.lit(system), sequence.cast("string")).cast("bigint").alias("batch_id"))
    base = pending.select(
        "cycle_date", "rnk", F.col("source_system_name").alias("base_source_system_name"),
        F.col("domain_name").alias("base_domain_name"), F.col("batch_id").cast("bigint").alias("base_batch_id"))
    return numbered.join(base, ["cycle_date", "rnk"]).select(
        F.lit(source_system).alias("source_system_name"), F.lit(domain).alias("domain_name"),
        F.lit(frequency).alias("batch_frequency"), "batch_id", "cycle_date",
        "base_source_system_name", "base_domain_name", "base_batch_id",
    ).distinct()


def current_batches(derived: DataFrame, recorded: Column) -> DataFrame:
    return derived.select(
        "batch_id", "cycle_date", recorded.alias("recorded_timestamp"), "domain_name",
        F.col("source_system_name").alias("source_system"), "batch_frequency").distinct()


def newly_completed(current: DataFrame, completed: DataFrame, recorded: Column) -> DataFrame:
    """Current batches that are not registered as completed yet."""
    key = [*DOMAIN, "batch_id"]
    return current.join(completed.select(*key).distinct(), key, "left_anti").select(
        "batch_id", "cycle_date", recorded.alias("recorded_timestamp"), *DOMAIN).distinct()


def ready_dates(tracking: DataFrame, bases: DataFrame, own_last: Column, by_batch: bool = False) -> DataFrame:
    """Cycle dates (and batches) for which all required base domains are finished.

    Counted after the derived domain's own last batch.
    """
    done = tracking.where((F.col("phase_name") == "datawarehouse") & (F.col("load_status") == "complete"))
    keys = ["source_system_name", "cycle_date", *(["batch_id"] if by_batch else [])]
    needed = bases.groupBy("source_system_name").agg(F.countDistinct("domain_name").alias("_needed"))
    domains = bases.select("source_system_name", "domain_name").distinct()
    found = (
        done.where(F.col("batch_id") > own_last)
        .join(domains, ["source_system_name", "domain_name"])
        .groupBy(*keys)
        .agg(F.countDistinct("domain_name").alias("domains"), F.max("batch_id").alias("last_batch"))
    )
    return found.join(needed, "source_system_name").where(F.col("domains") == F.col("_needed")).drop("_needed")


def overlapping(current: DataFrame, history: DataFrame, both: bool = False) -> DataFrame:
    """Current batches inside the range of cycles (or batches) history already has.

    ``both`` is for domains with several batches a day: a date may come again,
    a batch number may not.
    """
    span = history.groupBy("source_system_name").agg(
        F.min("cycledate").alias("_c0"), F.max("cycledate").alias("_c1"),
        F.min("batchid").alias("_b0"), F.max("batchid").alias("_b1"))
    cycle = F.col("cycle_date").between(F.col("_c0"), F.col("_c1"))
    batch = F.col("batch_id").between(F.col("_b0"), F.col("_b1"))
    return current.join(span, "source_system_name").where(cycle & batch if both else cycle | batch).select(
        *current.columns)


def require_none(rows: DataFrame, text: str) -> None:
    if not rows.isEmpty():
        raise ValueError(text)


def duplicate_runs(current: DataFrame) -> DataFrame:
    """Cycle dates with more than one batch."""
    return current.groupBy(*DOMAIN, "cycle_date").agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > 1)


def already_completed(current: DataFrame, completed: DataFrame) -> DataFrame:
    key = [*DOMAIN, "cycle_date"]
    return current.join(completed.select(*key).distinct(), key, "left_semi")


def unfinished(current: DataFrame, done: DataFrame) -> DataFrame:
    """Current batches that have not gone through."""
    key = [*DOMAIN, "batch_id", "cycle_date"]
    return current.join(done.select(*key).distinct(), key, "left_anti")


def batch_count_mismatches(pending: DataFrame, expected: DataFrame) -> DataFrame:
    """Days on which a source has not sent the expected number of batches."""
    counted = pending.groupBy("source_system_name", "cycle_date").agg(
        F.countDistinct("batch_id").alias("actual_batch_count"))
    return counted.join(expected, "source_system_name").where(
        F.col("actual_batch_count") != F.col("number_of_batches"))


def coverage(pending: DataFrame, bases: list[tuple[str, str]]) -> DataFrame:
    """Per cycle date, the sources present and whether every base domain is there.

    ``bases`` is the configured list of (source, domain) pairs.
    """
    wanted = [(F.col("source_system_name") == s) & (F.col("domain_name") == d) for s, d in bases]
    return pending.where(reduce(lambda a, b: a | b, wanted)).groupBy("cycle_date").agg(
        F.array_sort(F.collect_set("source_system_name")).alias("source_systems"),
        (F.countDistinct("source_system_name", "domain_name") == len(set(bases))).alias("is_complete"))


def inforce_batch(batches: DataFrame, on: Column, previous_month: bool = False) -> DataFrame:
    """The last monthly batch up to a date.

    With ``previous_month``, a batch of the same month but another day gives
    way to the last one of the month before.
    """
    monthly = batches.where((F.col("batch_description") == "MONTHLY") & (F.col("effective_date") <= on))
    pick = [F.max("batch_id").alias("batch_id"), F.max("effective_date").alias("effective_date")]
    last = monthly.groupBy("source_system").agg(*pick)
    if not previous_month:
        return last
    end = F.last_day(F.add_months(on, -1))
    earlier = monthly.where(F.col("effective_date") <= end).groupBy("source_system").agg(
        F.max("batch_id").alias("_b"), F.max("effective_date").alias("_d"))
    same = (F.month("effective_date") == F.month(on)) & (F.col("effective_date") != on)
    return last.join(earlier, "source_system", "left").select(
        "source_system",
        F.when(same, F.col("_b")).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(same, F.col("_d")).otherwise(F.col("effective_date")).alias("effective_date"))


def nth_daily_batch(batches: DataFrame, on: Column, n: int) -> DataFrame:
    daily = batches.where((F.col("batch_description") == "DAILY") & (F.col("effective_date") <= on))
    distinct = daily.select("source_system", "batch_id", "effective_date").distinct()
    return nth_latest(distinct, ["source_system"], ["batch_id"], n)


def calendar_flags(cycles: DataFrame, month_ends: DataFrame, week_ends: DataFrame) -> DataFrame:
    """Whether a cycle date ends a month or, failing that, a week, and the cut-offs."""
    months = month_ends.select(
        F.col("monthend_date").alias("cycle_date"), "prev_monthend_date").distinct()
    weeks = week_ends.select(
        F.col("weekend_date").alias("cycle_date"), "source_system_name", "prev_weekend_date").distinct()
    joined = cycles.join(months, "cycle_date", "left").join(weeks, ["cycle_date", "source_system_name"], "left")
    is_month = F.col("prev_monthend_date").isNotNull()

    def january(years: int) -> Column:
        return F.date_format(F.make_date(F.year("cycle_date") - years, F.lit(1), F.lit(1)), "yyyyMMdd")

    return joined.select(
        *cycles.columns,
        F.when(is_month, "Y").otherwise("N").alias("monthend_flag"),
        F.when(~is_month & F.col("prev_weekend_date").isNotNull(), "Y").otherwise("N").alias("weekend_flag"),
        "prev_monthend_date",
        F.when(~is_month, F.col("prev_weekend_date")).alias("prev_weekend_date"),
        january(2).alias("two_year_from_cycle_date"),
        january(7).alias("seven_year_from_cycle_date"),
    )


def rerun_state(table: DataFrame, errors: DataFrame, cycle: Column, batch: Column, table_name: str) -> DataFrame:
    """One row: does this batch, or a later one, already have reprocessed rows?"""
    loaded = table.where(F.col("original_cycle_date").isNotNull() & F.col("original_batch_id").isNotNull()).select(
        ((F.col("cycle_date") == cycle) & (F.col("batch_id") == batch)
         & ((F.col("original_cycle_date") != cycle) | (F.col("original_batch_id") != batch))).alias("again"),
        ((F.col("cycle_date") > cycle) | (F.col("batch_id") > batch)).alias("later"))
    cleared = errors.where((F.col("table_name") == table_name) & (F.col("reprocess_flag") == "R")).select(
        ((F.col("original_cycle_date") == cycle) & (F.col("original_batch_id") == batch)).alias("again"),
        ((F.col("original_cycle_date") > cycle) | (F.col("original_batch_id") > batch)).alias("later"))
    return loaded.unionByName(cleared).agg(
        F.coalesce(F.bool_or("again"), F.lit(False)).alias("is_rerun"),
        F.coalesce(F.bool_or("later"), F.lit(False)).alias("is_backdated"))


def require_run_allowed(state: DataFrame, rerun: bool) -> None:
    row = state.first()
    if rerun:
        return
    if row["is_backdated"]:
        raise ValueError("back-dated run: later batches are already loaded")
    if row["is_rerun"]:
        raise ValueError("re-run: an earlier run of this batch cleared soft errors")
