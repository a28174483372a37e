"""Writes to several tables that count together.

The parts of a load are first written beside the tables, in the shared folder;
a marker row, written last, makes them count. Then each part goes to its
table, in a way that can be repeated: partitions are replaced, and appended
rows are looked for before they are appended. Whoever comes next after a run
that died finishes what has a marker and discards what has none, so no table
keeps half a load, and no row is there twice.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbook.session import remove, shared_folder
from quillbook.sources import tables

APPEND, REPLACE = "append", "replace"
MARKER = "part string, target string, how string, partition string, rows long"


def _digest(columns: list[str]) -> list[Column]:
    """128 bits of a row's values and of which of them are null."""
    text = [F.col(c).cast("string") for c in sorted(columns)]
    nulls = F.array([F.col(c).isNull() for c in sorted(columns)])
    return [F.xxhash64(F.lit(k), nulls, *text).alias(f"_d{k}") for k in (1, 2)]


@dataclass
class Journal:
    """The parts of one load. ``name`` must be the same when a load is started again."""

    spark: SparkSession
    name: str
    parts: list[tuple] = field(default_factory=list)

    @property
    def path(self) -> str:
        return f"{shared_folder(self.spark)}/journal/{self.name}"

    def put(self, rows: DataFrame, table: str, how: str, partition: dict | None = None) -> None:
        """Write a part; ``partition`` names the one that it replaces."""
        part = str(len(self.parts))
        fitting = tables.in_table_order(rows, self.spark.table(table).schema)
        fitting.write.mode("overwrite").parquet(f"{self.path}/parts/{part}")
        self.parts.append((part, table, how, json.dumps(partition or {}, default=str), self._part(part).count()))

    def commit(self) -> None:
        self.spark.createDataFrame(self.parts, MARKER).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/marker")

    def committed(self) -> list:
        """The parts that the marker names, none where it is missing."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/marker/_SUCCESS")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return []
        return self.spark.read.schema(MARKER).parquet(f"{self.path}/marker").orderBy("part").collect()

    def _part(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/parts/{part}")

    def _append(self, rows: DataFrame, table: str, wanted: int) -> None:
        """Append unless the rows are there already; where only some are, these go first."""
        if not wanted:
            return
        known = rows.select(*_digest(rows.columns)).distinct()
        # Only partitions that the rows belong to can hold them.
        by = [c.name for c in self.spark.catalog.listColumns(table) if c.isPartition]
        there = self.spark.table(table)
        if by:
            there = there.join(rows.select(*by).distinct(), by, "left_semi")
        there = there.select("*", *_digest(rows.columns))
        found = there.join(known, ["_d1", "_d2"], "left_semi").count()
        if found == wanted:
            return
        if not found:
            tables.append(rows, table)
            return
        # A run died while its files were moved: the partitions are put together anew, beside the table first.
        whole = there.join(known, ["_d1", "_d2"], "left_anti").drop("_d1", "_d2").unionByName(rows.select(*there.columns[:-2]))
        whole.write.mode("overwrite").parquet(f"{self.path}/whole")
        tables.overwrite_partitions(self.spark.read.parquet(f"{self.path}/whole"), table)

    def apply(self) -> None:
        """Bring the marked parts to their tables, however far an earlier run came, and forget the journal."""
        for p in self.committed():
            rows = self._part(p["part"])
            if p["how"] == APPEND:
                self._append(rows, p["target"], p["rows"])
            else:
                tables.replace_partition(rows, p["target"], json.loads(p["partition"]))
        self.discard()

    def discard(self) -> None:
        remove(self.spark, self.path)

    def recover(self) -> bool:
        """Finish (true) or discard what an earlier run of this load has left."""
        finished = bool(self.committed())
        self.apply()
        return finished
