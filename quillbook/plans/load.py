"""The loads end to end: classify, record errors, load, reconcile."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbook.operators import classify, controls, errors
from quillbook.operators.batch import Batch
from quillbook.session import control_table, materialise, stages
from quillbook.sources import extracts as ex
from quillbook.sources import tables
from quillbook.sources.journal import APPEND, REPLACE, Journal


@dataclass(frozen=True)
class Lookups:
    subledgers: DataFrame
    ledgers: DataFrame
    reinsurance: DataFrame
    names: classify.LookupNames = classify.LookupNames()

    def written(self) -> Lookups:
        """The same tables in the shared folder.

        For lookups read from a database: their size is unknown to the planner
        until they are written, and they are fetched once.
        """
        return Lookups(*[materialise(t, "lookup") for t in (self.subledgers, self.ledgers, self.reinsurance)], self.names)

    def in_force(self, batch: Batch) -> tuple[DataFrame, DataFrame, DataFrame]:
        return (
            ex.subledger_map(self.subledgers, batch.cycle()),
            ex.ledger_map(self.ledgers, batch.cycle()),
            ex.reinsurance_map(self.reinsurance),
        )


@dataclass(frozen=True)
class Outcome:
    """What a batch load produces. All parts read the classified rows, which are written once."""

    rows: DataFrame
    hard: DataFrame
    cleared: DataFrame
    soft: DataFrame
    final: DataFrame


def header_rows(raw: list[DataFrame], lookups: Lookups, batch: Batch, carried: DataFrame | None = None) -> DataFrame:
    """Prepared header rows: new ones and carried soft errors."""
    rows = classify.in_batch(ex.header_rows(raw, batch.cycle_number), batch)
    return classify.prepare_headers(classify.with_carried(rows, carried), *lookups.in_force(batch))


def _all_lines(raw: list[DataFrame], batch: Batch, carried: DataFrame | None) -> DataFrame:
    rows = classify.in_batch(ex.line_rows(raw, batch.cycle_number), batch)
    if carried is not None:
        carried = carried.withColumn("random_counter", F.monotonically_increasing_id())
    return classify.with_carried(rows, carried)


def line_rows(raw: list[DataFrame], lookups: Lookups, batch: Batch, carried: DataFrame | None = None) -> DataFrame:
    return classify.prepare_lines(_all_lines(raw, batch, carried), *lookups.in_force(batch))


def load_headers(
    raw: list[DataFrame], lookups: Lookups, batch: Batch, carried: DataFrame | None = None
) -> Outcome:
    prepared = header_rows(raw, lookups, batch, carried)
    classified = materialise(classify.classify_headers(prepared, batch, lookups.names), "headers")
    rows = classify.force_transactions(classified, batch, "transaction_number_drvd")
    fields, derived = errors.HEADER_FIELDS, errors.HEADER_DERIVED
    return Outcome(
        rows,
        errors.hard_errors(rows, batch, fields, derived),
        errors.cleared_errors(rows, batch, fields, derived),
        errors.soft_errors(rows, batch, fields, derived),
        classify.final_headers(rows, batch),
    )


def classified_lines(
    raw: list[DataFrame], lookups: Lookups, headers: Outcome, batch: Batch, carried: DataFrame | None = None
) -> DataFrame:
    """Line rows classified against the headers of their batch.

    Headers and forced pairs are written first: their size then decides how
    the lines are joined to them.
    """
    pairs = control_table(classify.forced_header_pairs(headers.rows, batch))
    loaded = materialise(classify.run_headers(headers.final, batch), "run-headers")
    within = [*raw, carried] if carried is not None else raw
    return classify.classify_lines(
        line_rows(raw, lookups, batch, carried), loaded, pairs, batch, within,
        lambda: classify.most_lines(_all_lines(raw, batch, carried), *lookups.in_force(batch)))


def load_lines(
    raw: list[DataFrame],
    lookups: Lookups,
    headers: Outcome,
    batch: Batch,
    carried: DataFrame | None = None,
    outbound: bool = False,
) -> Outcome:
    classified = materialise(classified_lines(raw, lookups, headers, batch, carried), "lines")
    rows = classify.force_transactions(classified, batch, "transaction_number")
    valid = classify.valid_lines(rows, batch, outbound)
    fields, derived = errors.LINE_FIELDS, errors.LINE_DERIVED
    return Outcome(
        rows,
        errors.hard_errors(rows, batch, fields, derived),
        errors.cleared_errors(valid, batch, fields, errors.CLEARED_LINE_DERIVED),
        errors.soft_errors(rows, batch, fields, derived),
        classify.final_lines(valid, batch),
    )


def _journal(spark: SparkSession, batch: Batch, error_table: str, kind: str) -> Journal:
    name = f"{error_table}-{batch.table_name}-{batch.cycle_date}-{batch.batch_id}-{kind}".replace("/", "_").replace(".", "_")
    return Journal(spark, name)


def store(outcome: Outcome, batch: Batch, table: str, error_table: str) -> None:
    """Write a load: errors and the final set, all of them or none.

    Hard and cleared rows are appended. Soft rows and the batch's partition of
    the table replace what was there, also when there are none. Where an
    earlier run of this load died after its parts had been written, these are
    brought to the tables and the outcome given here is not.
    """
    journal = _journal(outcome.final.sparkSession, batch, error_table, "store")
    if journal.recover():
        return
    journal.put(outcome.hard.unionByName(outcome.cleared), error_table, APPEND)
    journal.put(outcome.soft, error_table, REPLACE, {"table_name": batch.table_name, "reprocess_flag": errors.SOFT})
    journal.put(outcome.final, table, REPLACE, {"cycle_date": batch.cycle_date, "batch_id": batch.batch_id})
    journal.commit()
    journal.apply()


def carried_errors(error_table: DataFrame, batch: Batch, fields: list[str]) -> DataFrame:
    """Soft errors of earlier batches as rows to be classified again."""
    return errors.explode_errors(errors.reprocessable(error_table, batch), fields)


def prepare_errors(spark: SparkSession, batch: Batch, error_table: str, rerun: bool = False) -> None:
    """Put the error table back to where it was before an earlier run of this batch.

    The new content is written to the shared folder before any partition of
    the table is replaced, as it is computed from that table.
    """
    with stages(spark):
        _restore_errors(spark, batch, error_table, rerun)


def _restore_errors(spark: SparkSession, batch: Batch, error_table: str, rerun: bool) -> None:
    rows = materialise(spark.table(error_table).where(F.col("table_name") == batch.table_name), "errors")
    if rows.isEmpty():
        return
    schema = errors.error_schema(rows)
    retried = errors.reinstate_processed(errors.repair_rerun_markers(rows, rerun), batch, schema)
    kept = [
        retried.where(F.col("reprocess_flag") == errors.CLEARED),
        errors.reinstate_errors(retried, batch, errors.SOFT, schema, rerun),
        errors.reinstate_errors(rows, batch, errors.HARD, schema, rerun),
    ]
    restored = materialise(reduce(DataFrame.unionByName, kept), "errors")
    for flag in (errors.SOFT, errors.HARD, errors.CLEARED):
        tables.replace_partition(
            restored.where(F.col("reprocess_flag") == flag), error_table,
            {"table_name": batch.table_name, "reprocess_flag": flag})


def age_errors(
    spark: SparkSession, batch: Batch, error_table: str, max_days: int = errors.MAX_AGE_DAYS, paired: bool = False
) -> None:
    """Turn the soft errors that are too old into hard ones in the table; both partitions change or none.

    With ``paired``, for the headers of a domain that has lines as well: refused
    where only headers or only lines of the source system have errors that old.
    """
    journal = _journal(spark, batch, error_table, "age")
    if journal.recover():
        return
    if paired:
        system = F.split_part("table_name", F.lit("_"), F.lit(1)) == batch.source_system
        errors.require_aged_pairs(spark.table(error_table).where(system), batch.cycle(), max_days)
    soft = spark.table(error_table).where(
        (F.col("table_name") == batch.table_name) & (F.col("reprocess_flag") == errors.SOFT))
    if soft.isEmpty():
        return
    with stages(spark):
        aged = materialise(errors.age_soft_errors(soft, batch, errors.error_schema(soft), max_days), "aged")
        journal.put(aged.where(F.col("reprocess_flag") == errors.HARD), error_table, APPEND)
        journal.put(aged.where(F.col("reprocess_flag") == errors.SOFT), error_table, REPLACE, {
            "table_name": batch.table_name, "reprocess_flag": errors.SOFT})
    journal.commit()
    journal.apply()


def load_log(
    raw_rows: DataFrame, excluded: DataFrame, outcome: Outcome, measures: list[controls.Measure], batch: Batch,
    target_measures: list[controls.Measure] | None = None,
) -> DataFrame:
    """Measures of the curated hop under all tags.

    Rows that carry text amounts are tagged and measured together, the target
    with its own column types.
    """
    fields = sorted({f for m in measures for f in m.fields if f in raw_rows.columns})
    good = F.col("error_cleared").startswith("Good")
    own = batch.originates()

    def tagged(rows: DataFrame, tag: Column) -> DataFrame:
        return rows.select(*fields, tag.alias("_tag")).where(F.col("_tag").isNotNull())

    text = (
        tagged(raw_rows, F.lit("S"))
        .unionByName(tagged(excluded, F.lit("SA")))
        .unionByName(tagged(outcome.rows, F.when(own & ~good, "SI").when(good & ~own, "TA")))
    )
    source = controls.measure(text, measures, F.col("_tag"), batch.domain, "curated")
    target = controls.measure(outcome.final, target_measures or measures, "T", batch.domain, "curated")
    return source.unionByName(target)
