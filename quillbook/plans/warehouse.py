"""The warehouse hop: staging, working set, history.

History is a log of loads below one folder:

* ``versions``: what each load brought, in a folder per load; versions that
  were open when written stand apart from those that already had an end;
* ``closures``: key, start and end of the versions that a load ended;
* ``commits``: a row per load. It is written last, in one file, and only what
  it names counts. A load that dies before leaves nothing to be seen, and its
  second run writes over its folders.

So a load writes its own versions and closures and rewrites nothing; what it
reads of history is the key, the hash and the dates of versions written open.
Reading puts each open version together with its closure. ``compact`` applies
the closures collected so far and starts over: it reads and writes open
versions only, what has an end is never written again. ``vacuum`` removes the
folders that no commit names any more.

One load writes at a time; a second one finds its commit taken and fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillbook.operators import controls, scd2
from quillbook.operators.cdc import INSERT, UNCHANGED, UPDATE
from quillbook.operators.scd2 import ACTION, BATCH, CYCLE, HASH, KEY, SOURCE, START, STOP
from quillbook.session import materialise, remove
from quillbook.sources import tables

COMMIT = "seq long, kind string, batch long, cycle date, newest long, versions long, closures long"
LOAD, DELETE, COMPACT, CREATE = "load", "delete", "compact", "create"
#: Where the parts of a load are: versions written open, versions written with an end, closures.
OPENED, ENDED, CLOSURES = "versions/state=open", "versions/state=ended", "closures"
NARROW = [KEY, HASH, START, STOP, BATCH, CYCLE]


@dataclass(frozen=True)
class History:
    spark: SparkSession
    path: str
    steps: scd2.Steps = scd2.Steps()

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: StructType, steps: scd2.Steps = scd2.Steps()) -> History:
        """An empty history for versions of this schema."""
        made = cls(spark, path, steps)
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(f"{path}/schema")
        made._commit(0, CREATE)
        return made

    # Reading.

    @property
    def schema(self) -> StructType:
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def _log(self) -> list:
        """The commits in order: a row per load."""
        return self.commits().orderBy("seq").collect()

    def _read(self, part: str, schema: StructType, numbers: list[int]) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{part}/seq={n}" for n in numbers])

    def _parts(self, log: list | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Versions written open, their closures, and versions written with an end."""
        log = [r for r in log or self._log() if r["kind"] != CREATE]
        base = max((r["seq"] for r in log if r["kind"] == COMPACT), default=0)
        schema = self.schema
        closing = StructType([schema[KEY], schema[START], schema[STOP], schema[BATCH]])
        return (
            self._read(OPENED, schema, [r["seq"] for r in log if r["seq"] >= base and r["kind"] != DELETE]),
            self._read(CLOSURES, closing, [r["seq"] for r in log if r["seq"] > base and r["closures"]]),
            self._read(ENDED, schema, [r["seq"] for r in log if r["kind"] != DELETE]),
        )

    def _merged(self, opened: DataFrame, closures: DataFrame) -> DataFrame:
        ends = closures.select(KEY, START, F.col(STOP).alias("_stop"))
        return opened.join(ends, [KEY, START], "left").withColumn(STOP, F.coalesce("_stop", STOP)).select(*opened.columns)

    def versions(self) -> DataFrame:
        """All versions with the ends they have by now."""
        opened, closures, ended = self._parts()
        return self._merged(opened, closures).unionByName(ended)

    def in_force(self, columns: list[str] | None = None, log: list | None = None) -> DataFrame:
        """The versions without an end; of the closures only key and start are read."""
        opened, closures, _ = self._parts(log)
        rows = opened.select(*dict.fromkeys([KEY, START, *(columns or opened.columns)]))
        return rows.join(closures.select(KEY, START), [KEY, START], "left_anti").select(*(columns or opened.columns))

    def closed_by(self, batches: list[int]) -> DataFrame:
        """Key, start and end of the versions that loads of these batches ended, whether compacted since or not."""
        log = [r["seq"] for r in self._log() if r["kind"] in (LOAD, DELETE) and r["batch"] in batches and r["closures"]]
        schema = self.schema
        return self._read(CLOSURES, StructType([schema[KEY], schema[START], schema[STOP], schema[BATCH]]), log)

    # Writing.

    def _commit(self, seq: int, kind: str, batch: int | None = None, newest: tuple = (None, None), versions: int = 0, closures: int = 0) -> None:
        row = self.spark.createDataFrame([(seq, kind, batch, newest[0], newest[1], versions, closures)], COMMIT)
        row.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/{seq:08d}")

    def _write(self, rows: DataFrame, part: str, seq: int) -> int:
        """Write one part of a load, over what a run that died may have left; how many rows it has."""
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/{part}/seq={seq}")
        return seen.get["n"]

    def _add(self, seq: int, kind: str, batch: int, newest: tuple, versions: DataFrame | None, closures: DataFrame) -> None:
        found = 0
        if versions is not None:
            rows = tables.in_table_order(versions, self.schema)
            is_open = scd2.is_open(self.steps)
            found = self._write(rows.where(is_open), OPENED, seq) + self._write(rows.where(~is_open), ENDED, seq)
        ends = closures.select(KEY, START, STOP, F.lit(batch).cast("bigint").alias(BATCH))
        self._commit(seq, kind, batch, newest, found, self._write(ends, CLOSURES, seq))

    def require_new(self, batch: int, cycle, newest: int, log: list | None = None) -> None:
        """Refuse what is loaded already, or is below what history holds. The log of loads tells."""
        loads = [r for r in log or self._log() if r["kind"] in (LOAD, DELETE)]
        if any(r["kind"] == LOAD and r["batch"] == batch for r in loads):
            raise ValueError("the batch is already loaded")
        if any(r["batch"] > batch or (r["newest"] or newest) > newest or (r["cycle"] or cycle) > cycle for r in loads):
            raise ValueError("history already holds a later cycle or batch")

    def adopt(self, versions: DataFrame, batch: int) -> None:
        """Start an empty history with versions that exist already."""
        if len(self._log()) > 1:
            raise ValueError("history is not empty")
        rows = materialise(versions, "adopted")
        newest = rows.agg(F.max(CYCLE), F.max(BATCH)).first()
        self._add(1, LOAD, batch, tuple(newest), rows, rows.where(F.lit(False)))

    def load(self, staging: DataFrame, batch: int) -> DataFrame:
        """Apply a staging table and return the working set (of open versions, key, hash, dates and batch only)."""
        staging = materialise(staging, "staging")
        newest = staging.agg(F.max(CYCLE), F.max(BATCH)).first()
        log = self._log()
        if newest[0] is not None:
            self.require_new(batch, *newest, log)
        working = materialise(scd2.working_type2(staging, self.in_force(NARROW, log), self.steps), "working")
        if newest[0] is not None:
            new, ended = (working.where(F.col(ACTION) == a) for a in (INSERT, UPDATE))
            self._add(log[-1]["seq"] + 1, LOAD, batch, tuple(newest), new, ended)
        return working

    def delete(self, deletes: DataFrame, batch: int) -> None:
        """End the open versions of deleted documents at the date the delete names."""
        gone = deletes.groupBy(F.col("documentid").alias(KEY)).agg(
            F.max(F.col("pointofviewstopdate").cast(self.steps.type)).alias(STOP))
        log = self._log()
        self._add(log[-1]["seq"] + 1, DELETE, batch, (None, None), None, self.in_force([KEY, START], log).join(gone, KEY))

    def compact(self) -> None:
        """Write the open versions anew, without those that have ended since; these get their place among the ended."""
        log = self._log()
        seq = log[-1]["seq"] + 1
        opened, closures, _ = self._parts(log)
        merged = materialise(self._merged(opened, closures), "merged")
        is_open = scd2.is_open(self.steps)
        found = self._write(merged.where(is_open), OPENED, seq) + self._write(merged.where(~is_open), ENDED, seq)
        self._commit(seq, COMPACT, versions=found)

    def vacuum(self) -> list[str]:
        """Remove versions that a compaction has replaced. Readers that began before it must have ended."""
        log = [r for r in self._log() if r["kind"] != CREATE]
        base = max((r["seq"] for r in log if r["kind"] == COMPACT), default=0)
        gone = [f"{self.path}/{OPENED}/seq={r['seq']}" for r in log if r["seq"] < base and r["kind"] != DELETE]
        return [p for p in gone if remove(self.spark, p)]


def closing_batches(rows: DataFrame, batches: DataFrame, steps: scd2.Steps = scd2.Steps()) -> DataFrame:
    """Ended versions under the batch on whose start they end (the next day, or the next minute's day).

    ``batches`` has one batch per cycle date: ``cycle_date, batch_id``.
    """
    start = F.to_date(F.timestamp_add("MINUTE", F.lit(1), F.col(STOP))) if steps.intraday else F.date_add(STOP, 1)
    named = batches.select(F.col("cycle_date").alias(CYCLE), F.col("batch_id").cast("bigint").alias(BATCH)).distinct()
    return rows.drop(CYCLE, BATCH).withColumn(CYCLE, start).join(named, CYCLE)


def replayed(
    staging: DataFrame, before: DataFrame, history: History, closed: DataFrame, batches: DataFrame,
    fields: list[str], group: list[str] | None = None, unchanged: DataFrame | None = None,
) -> DataFrame:
    """What a load should have done and what it did, as one set of tagged rows: ``fields``, batch, cycle, ``tag``.

    * ``S``: versions that a replay of the staged rows over the open versions before the load makes new;
    * ``SI``: staged rows that repeat a version, and rows a feed with change detection sent as unchanged;
    * ``SA``: versions that the replay ends, under the batch that ends them;
    * ``T``: versions of these batches in history;
    * ``TA``: versions in history that the load has ended, under the batch on whose start they end.

    ``before`` holds the open versions before the load, ``closed`` key and start of those it ended.
    """
    steps = history.steps
    expected = scd2.expected_outcome(staging, before, steps, group)
    staged = expected.where(F.col(SOURCE) == "Staging")
    kept = [*dict.fromkeys(fields), BATCH, CYCLE]
    tag = F.when(F.col(ACTION) == INSERT, "S").otherwise("SI")
    ending = closing_batches(expected.where(F.col(ACTION) == UPDATE), batches, steps)
    named = batches.select(F.col("batch_id").cast("bigint").alias(BATCH), F.col("cycle_date").alias(CYCLE)).distinct()
    versions = history.versions()
    target = versions.join(named, [BATCH, CYCLE], "left_semi")
    ended = closing_batches(versions.join(closed.select(KEY, START), [KEY, START], "left_semi"), batches, steps)
    parts = [
        staged.select(*kept, tag.alias("tag")), ending.select(*kept, F.lit("SA").alias("tag")),
        target.select(*kept, F.lit("T").alias("tag")), ended.select(*kept, F.lit("TA").alias("tag"))]
    if unchanged is not None:
        same = unchanged.where(F.col("cdc_action") == UNCHANGED).withColumns({
            BATCH: F.col("batch_id").cast("bigint"), CYCLE: F.col("cycle_date")})
        parts.append(same.join(named, [BATCH, CYCLE], "left_semi").select(*kept, F.lit("SI").alias("tag")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def balance_replay(rows: DataFrame, measures: list[controls.Measure], domain: str) -> DataFrame:
    """Measures of :func:`replayed` rows per batch: new and ended versions as expected against those in history.

    All tags are measured in one aggregation. The unchanged rows stand by themselves.
    """
    log = controls.measure(rows, measures, F.col("tag"), domain, "datawarehouse", by=(BATCH, CYCLE))
    keys = [BATCH, CYCLE, "operation", "control_id", "fact_col_name", "group_col_name", "group_col_val"]
    return controls.replay_balance(log, keys)


def append_rows(spark: SparkSession, table: str, staging: DataFrame) -> None:
    """Append pattern: the table is partitioned by batch, so a batch replaces itself."""
    rows = scd2.working_append(staging).drop(scd2.ACTION, scd2.SOURCE)
    tables.overwrite_partitions(materialise(rows, "append"), table)
