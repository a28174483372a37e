"""Change and delete detection between a new set and what was loaded before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbook.functions.identity import row_hash
from quillbook.operators.batch import Batch
from quillbook.sources.extracts import latest

INSERT, UPDATE, UNCHANGED, DELETE = "INSERT", "UPDATE", "UNCHANGED", "DELETE"
DELETE_CODE = "DELT"


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_o_{k}"]) for k in keys])


def change_actions(
    new: DataFrame, loaded: DataFrame, keys: list[str], fields: list[str], batch: Batch, deletes: DataFrame | None = None
) -> DataFrame:
    """``INSERT`` for new or changed rows, ``UNCHANGED`` for the others.

    Each row is compared with the latest one of its key before this batch; a
    null differs from ''. ``deletes`` names keys and the batch that deleted
    them: a row that an earlier batch deleted after it was loaded is no prior
    version, so a document that returns is an ``INSERT``. Only keys and hashes
    of loaded rows travel through the shuffle.
    """
    before = loaded.where(F.col("batch_id") < batch.number()).select(
        *keys, "cycle_date", "batch_id", row_hash(fields, nulls=True).alias("_hash"))
    before = latest(before, keys, ["cycle_date", "batch_id"]).select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.col("batch_id").alias("_o_batch"), F.col("_hash").alias("_o_hash"))
    if deletes is not None:
        gone = deletes.where(F.col("batch_id") < batch.number()).groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys]).agg(
            F.max("batch_id").alias("_deleted"))
        same = reduce(lambda a, b: a & b, [F.col(f"_o_{k}").eqNullSafe(F.col(f"_d_{k}")) for k in keys])
        before = before.join(gone, same & (F.col("_deleted") >= F.col("_o_batch")), "left_anti")
    before = before.drop("_o_batch")
    hashed = new.withColumn("_hash", row_hash(fields, nulls=True))
    joined = hashed.join(before, _null_safe(hashed, before, keys), "left")
    return joined.withColumns({
        "cdc_action": F.when(F.col("_hash").eqNullSafe(F.col("_o_hash")), UNCHANGED).otherwise(INSERT),
        "recorded_timestamp": batch.recorded(),
        "cycle_date": batch.cycle(),
        "batch_id": batch.number(),
    }).drop("_hash", "_o_hash", *[f"_o_{k}" for k in keys])


def _deletes(ids: DataFrame, batch: Batch) -> DataFrame:
    return ids.select("documentid").distinct().select(
        batch.recorded().alias("recorded_timestamp"),
        "documentid",
        F.date_sub(batch.cycle(), 1).alias("pointofviewstopdate"),
        batch.number().alias("batch_id"),
        F.lit(batch.domain).alias("domain_name"),
        F.lit(batch.source_system).alias("source_system_name"),
        F.lit(batch.frequency).alias("batch_frequency"),
        batch.cycle().alias("cycle_date"),
    )


def missing_keys(loaded: DataFrame, final: DataFrame, batch: Batch) -> DataFrame:
    """Full feed: documents of this batch that the final set no longer has."""
    own = loaded.where((F.col("cycle_date") == batch.cycle()) & (F.col("batch_id") == batch.number()))
    return _deletes(own.join(final.select("documentid"), "documentid", "left_anti"), batch)


def coded_deletes(rows: DataFrame, batch: Batch, code: str = "operationcode") -> DataFrame:
    """Delta feed: documents that carry the delete code."""
    return _deletes(rows.where(F.col(code) == DELETE_CODE), batch)


def without_deletes(rows: DataFrame, code: str = "operationcode") -> DataFrame:
    """Rows to insert: no delete rows, no helper columns. A null code is kept."""
    return rows.where(~F.col(code).eqNullSafe(DELETE_CODE)).drop(code, "fltr")


def one_per_document(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each document by ascending order, nulls first.

    A partial aggregate: a document with very many rows is reduced before the
    shuffle.
    """
    first = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_first")
    return rows.groupBy(*keys).agg(first).select("_first.*")


def dropped_copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the rows beyond one per key, with how many there are of each.

    The rows that ``exceptAll(dropDuplicates)`` would list, kept as counts: a
    key with very many copies stays a single row.
    """
    return rows.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("dropped")).where(F.col("dropped") > 0)


def newly_expired(expired: DataFrame, seen: DataFrame, batch: Batch) -> DataFrame:
    """Expired contracts that no earlier cycle has listed."""
    earlier = seen.where(
        (F.col("domain_name") == batch.domain)
        & (F.col("source_system") == batch.source_system)
        & (F.col("cycle_date") < batch.cycle()))
    keys = ["policy_id", "policy_no"]
    return expired.join(earlier.select(*keys).distinct(), keys, "left_anti").select(
        batch.recorded().alias("recorded_timestamp"), "policy_no", "policy_id",
        batch.number().alias("batch_id"), F.lit(batch.source_system).alias("source_system"),
        F.lit(batch.domain).alias("domain_name"), batch.cycle().alias("cycle_date"),
    )


def without_expired(rows: DataFrame, expired: DataFrame, contract: str = "contractnumber") -> DataFrame:
    return rows.join(expired, rows[contract] == expired["policy_no"], "left_anti")
