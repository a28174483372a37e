"""Staging, working and history tables with type 2 versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbook.functions.groups import Large, find_large, neighbour, number_rows
from quillbook.functions.identity import row_hash
from quillbook.operators.cdc import INSERT, UNCHANGED, UPDATE
from quillbook.operators.lookups import in_force_on
from quillbook.session import control_table, materialise
from quillbook.sources.extracts import latest
from quillbook.sources.tables import replace_batches

KEY, HASH = "naturalkeyhashvalue", "hashvalue"
START, STOP = "pointofviewstartdate", "pointofviewstopdate"
BATCH, CYCLE = "batchid", "cycledate"
ACTION, SOURCE = "actiontype", "sourcetable"

# Fixed value: the stop date of a version in force.
OPEN = "9999-12-31"
SLOT_MINUTES = 30


@dataclass(frozen=True)
class Steps:
    """How versions follow each other: by day, or by minute within a day."""

    intraday: bool = False

    @property
    def type(self) -> str:
        return "timestamp" if self.intraday else "date"

    def open(self) -> Column:
        return F.lit(OPEN).cast(self.type)

    def before(self, start: Column) -> Column:
        return start - F.expr("interval 1 minute") if self.intraday else F.date_sub(start, 1)

    def order(self) -> list[str]:
        return [BATCH, START, STOP] if self.intraday else [START, STOP, BATCH]


def _in_batches(rows: DataFrame, batches: DataFrame) -> DataFrame:
    keys = ["cycle_date", "batch_id"]
    return rows.join(control_table(batches.select(*keys)), keys)


def staging_type2(
    rows: DataFrame, batches: DataFrame, keys: list[str], fields: list[str], steps: Steps = Steps()
) -> DataFrame:
    """Versions to load: key hash, data hash and an open validity from the cycle date.

    ``batches`` names the batches to load; a feed with change detection sends
    its ``INSERT`` rows only.
    """
    if "cdc_action" in rows.columns:
        rows = rows.where(F.col("cdc_action") == INSERT)
    chosen = _in_batches(rows, batches)
    return chosen.select(
        row_hash(keys).alias(KEY),
        row_hash(fields).alias(HASH),
        F.col("cycle_date").cast(steps.type).alias(START),
        steps.open().alias(STOP),
        F.col("batch_id").cast("bigint").alias(BATCH),
        F.col("cycle_date").alias(CYCLE),
        *dict.fromkeys([*keys, *fields]),
    )


def staging_append(rows: DataFrame, batches: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    chosen = _in_batches(rows, batches)
    kept = [c for c in chosen.columns if c not in ("cycle_date", "batch_id", *exclude)]
    return chosen.select(
        F.col("batch_id").cast("bigint").alias(BATCH), F.col("cycle_date").alias(CYCLE), *kept)


def working_append(staging: DataFrame) -> DataFrame:
    return staging.withColumns({ACTION: F.lit(INSERT), SOURCE: F.lit("Staging")})


def append_to_history(history: DataFrame, working: DataFrame, batches: DataFrame, keys: list[str]) -> DataFrame:
    """Append ``INSERT`` rows; rows of the same batches from an earlier run go first."""
    rows = working.where(F.col(ACTION) == INSERT).drop(ACTION, SOURCE)
    return replace_batches(history, rows, batches, keys)


def is_open(steps: Steps = Steps()) -> Column:
    return F.col(STOP) == steps.open()


def _actions(staging: DataFrame, history: DataFrame, steps: Steps) -> tuple[DataFrame, Large]:
    """Staged versions and the open ones they meet, with the action each would take by itself.

    Of the open ones key, hash, dates and batch are enough.
    """
    current = history.where(is_open(steps)).join(staging.select(KEY).distinct(), KEY, "left_semi")
    rows = staging.withColumn(SOURCE, F.lit("Staging")).unionByName(
        current.withColumn(SOURCE, F.lit("Target")), allowMissingColumns=True)
    # A key has at most one open version, so the staged rows tell how large it is.
    large = find_large(staging, [KEY], within=[staging])
    rows = neighbour(rows, [KEY], [START, BATCH, SOURCE], "_previous", F.col(HASH), large=large)
    rows = rows.withColumn(ACTION, (
        F.when(F.col(SOURCE) == "Target", UPDATE)
        .when(F.col(HASH) == F.col("_previous"), UNCHANGED)
        .otherwise(INSERT)
    )).drop("_previous")
    return rows, large


def working_type2(staging: DataFrame, history: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Staged versions and the open ones they meet, with action and validity.

    ``UPDATE`` rows are open versions to close, ``INSERT`` rows new versions;
    ``UNCHANGED`` rows repeat the version before them or stay open.
    """
    return _validity(*_actions(staging, history, steps), steps)


def _validity(rows: DataFrame, large: Large, steps: Steps) -> DataFrame:
    active = F.col(ACTION) != UNCHANGED
    rows = neighbour(rows, [KEY], steps.order(), "_next", F.col(START), following=True, among=active,
                     large=large)
    stop = F.when(active, F.coalesce(steps.before(F.col("_next")), steps.open())).otherwise(F.col(STOP))
    rows = rows.withColumn(STOP, stop).drop("_next")
    untouched = (F.col(SOURCE) == "Target") & is_open(steps)
    rows = rows.withColumn(ACTION, F.when(untouched, UNCHANGED).otherwise(F.col(ACTION)))
    return _slots(rows, steps, large) if steps.intraday else rows


def _slots(rows: DataFrame, steps: Steps, large: Large) -> DataFrame:
    """Spread the versions of one key and day over half-hour slots.

    Slots count from midnight, or from the slot of the open version when that
    one is of the same day.
    """
    active = F.col(ACTION) != UNCHANGED
    midnight = F.date_trunc("day", F.col(START))
    minutes = F.timestamp_diff("MINUTE", midnight, F.col(START))
    slot = F.when(F.col(SOURCE) == "Target", F.floor(minutes / SLOT_MINUTES))
    days = rows.where(active).groupBy(KEY, CYCLE).agg(
        F.count(F.lit(1)).alias("_versions"), F.coalesce(F.max(slot), F.lit(0)).alias("_slot"))
    crowded = days.where(F.col("_versions") > 1).drop("_versions")
    rows = rows.withColumn("_active", active)
    ranked = number_rows(rows, [KEY, CYCLE, "_active"], steps.order(), "_rank",
                         # Days of a key that is not large are not large either.
                         large=None if large.ids else large)
    joined = ranked.join(crowded, [KEY, CYCLE], "left")
    moved = F.col("_active") & F.col("_slot").isNotNull()
    offset = (F.col("_slot") + F.col("_rank") - 1) * SLOT_MINUTES
    start = F.when(
        moved & (F.col(SOURCE) == "Staging"),
        F.timestamp_add("MINUTE", offset.cast("int"), midnight),
    ).otherwise(F.col(START))
    joined = joined.withColumn(START, start)
    ends = moved & ((F.col(SOURCE) == "Target") | ~is_open(steps))
    stop = F.when(ends, F.timestamp_add("MINUTE", F.lit(SLOT_MINUTES - 1), F.col(START))).otherwise(F.col(STOP))
    return joined.withColumn(STOP, stop).select(*[c for c in rows.columns if c != "_active"])


def load_state(history: DataFrame, working: DataFrame) -> str:
    """``new``, ``partial`` or ``loaded``: how much of the working set history has."""
    rows = working.where(F.col(ACTION) == INSERT).select(KEY, START, STOP, BATCH)
    both = rows.join(history.select(KEY, START, STOP, BATCH), [KEY, START, STOP, BATCH], "left_semi")
    found, wanted = both.count(), rows.count()
    if found == 0:
        return "new"
    return "loaded" if found == wanted else "partial"


def require_newest(history: DataFrame, cycle: Column, batch: Column) -> None:
    """Refuse to load below what history already holds."""
    later = history.where((F.col(CYCLE) > cycle) | (F.col(BATCH) > batch))
    if not later.isEmpty():
        raise ValueError("history already holds a later cycle or batch")


def close_versions(open_rows: DataFrame, working: DataFrame) -> DataFrame:
    """Open versions with the stop date their successors give them."""
    closing = working.where(F.col(ACTION) == UPDATE).select(KEY, START, F.col(STOP).alias("_stop"))
    joined = open_rows.join(closing, [KEY, START], "left")
    return joined.withColumn(STOP, F.coalesce("_stop", STOP)).select(*open_rows.columns)


def new_versions(working: DataFrame, columns: list[str]) -> DataFrame:
    return working.where(F.col(ACTION) == INSERT).select(*columns)


def apply_working(history: DataFrame, working: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """History with the working set applied. Closed versions pass through unjoined."""
    closed = history.where(~is_open(steps))
    touched = close_versions(history.where(is_open(steps)), working)
    return closed.unionByName(touched).unionByName(new_versions(working, history.columns))


def close_deleted(history: DataFrame, deletes: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Close the open versions of deleted documents at the date the delete names."""
    gone = deletes.groupBy(F.col("documentid").alias(KEY)).agg(
        F.max(F.col("pointofviewstopdate").cast(steps.type)).alias("_stop"))
    touched = history.where(is_open(steps)).join(gone, KEY, "left")
    touched = touched.withColumn(STOP, F.coalesce("_stop", STOP)).select(*history.columns)
    return history.where(~is_open(steps)).unionByName(touched)


def deleted_parents(parents: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Documents with closed versions only, and when the last of them ended."""
    closed = parents.where(~is_open(steps))
    gone = closed.select("documentid").subtract(parents.where(is_open(steps)).select("documentid"))
    last = latest(closed.select("documentid", STOP), ["documentid"], [STOP])
    return last.join(gone, "documentid", "left_semi")


def expected_outcome(
    staging: DataFrame, history: DataFrame, steps: Steps = Steps(), group: list[str] | None = None
) -> DataFrame:
    """What the load should do, worked out apart from it for the controls.

    Where one group and day has more than two rows, an ``INSERT`` or ``UPDATE``
    that follows another one is taken as superseded. Superseded rows are marked
    first, so no version ends where one of them starts.
    """
    rows, large = _actions(staging, history, steps)
    if not group:
        return _validity(rows, large, steps)
    # Written once: the days are counted and their rows put in order.
    rows = materialise(rows, "actions")
    day = [KEY, *group, CYCLE]
    counts = rows.groupBy(*day).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = counts.where(F.col("_rows") > 2).drop("_rows").withColumn("_crowded", F.lit(True))
    ordered = neighbour(rows, day, steps.order(), "_before", F.col(ACTION))
    again = (
        F.coalesce("_crowded", F.lit(False))
        & F.col(ACTION).isin(INSERT, UPDATE)
        & (F.col("_before") == F.col(ACTION))
    )
    marked = ordered.join(crowded, day, "left").withColumn(
        ACTION, F.when(F.coalesce(again, F.lit(False)), UNCHANGED).otherwise(F.col(ACTION))
    ).select(*rows.columns)
    return _validity(marked, large, steps)


def closed_by_batch(history: DataFrame, working: DataFrame, batches: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Versions whose end falls on the start of a batch that closed them.

    Measured as target adjustments: they belong to the batch that ended them.
    """
    ended = working.where(F.col(ACTION) == UPDATE).select(KEY, START, F.col(STOP).alias("_end"))
    start = F.to_date(F.timestamp_add("MINUTE", F.lit(1), F.col(STOP))) if steps.intraday else F.date_add(STOP, 1)
    closed = history.where(~is_open(steps)).withColumn("_starts", start)
    joined = closed.join(ended, [KEY, START]).where(F.col(STOP) == F.col("_end"))
    named = batches.select(F.col("cycle_date").alias("_starts"), F.col("batch_id").alias("closing_batch"))
    return joined.join(control_table(named), "_starts").drop("_starts", "_end")


def touched_documents(
    batches: DataFrame, contracts: DataFrame, relationships: DataFrame, parties: DataFrame, steps: Steps = Steps(), kind: str | None = None
) -> DataFrame:
    """Contract versions in force on a batch's cycle date that the batches touched.

    A contract is touched through itself, through one of its relationships or
    through the party of one of its relationships; with ``kind``, the latter
    through relationships of that type only (``relationshiptype``).
    """
    batches = control_table(batches.select("cycle_date", "batch_id", "source_system_name"))
    days = batches.select("cycle_date", "source_system_name", F.col("batch_id").alias("for_batch"))

    def loaded_in(df: DataFrame) -> DataFrame:
        named = batches.select(F.col("batch_id").alias(BATCH), "source_system_name")
        return df.join(named, [BATCH, "source_system_name"], "left_semi")

    def in_force(df: DataFrame) -> DataFrame:
        return in_force_on(df, days, ["source_system_name"], START, STOP, "cycle_date")

    own = loaded_in(contracts).select("documentid")
    linked = loaded_in(relationships).select(F.col("contract_documentid").alias("documentid"))
    changed = loaded_in(parties).select(F.col("documentid").alias("party_documentid"))
    through = relationships if kind is None else relationships.where(F.col("relationshiptype") == kind)
    # Both semi joins come before the versions meet the dates, so only what was touched is cut into cells.
    through = in_force(through.join(changed, "party_documentid", "left_semi")).select(
        F.col("contract_documentid").alias("documentid"))
    touched = own.unionByName(linked).unionByName(through).distinct()
    return in_force(contracts.join(touched, "documentid", "left_semi"))
