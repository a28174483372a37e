"""Sequences of a fixed length: documents are concatenated and cut.

The first pass writes the ids of every document with its place in its
partition. The partitions' totals (one row each) are summed up to the offset
at which each partition starts, so every document knows its global offset
without any global sort; sequence s is the window from s * length on. A
document that crosses a window's edge is cut there: one record per piece.

Every document ends with the id ``end``, so null and empty texts are one id
long. Only the last sequence can be shorter than ``length``. Repeated rows
are packed as often as they come; the order is that of the files read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillbook.llm.batches import chunks
from quillbook.llm.tokens import encoder
from quillbook.session import stage_path

#: Partition totals (16 bytes each) that are sent to every task; beyond that they are joined.
SENT_TOTALS = 2_000_000


def encoded(df: DataFrame, path: str, end: int = 0) -> DataFrame:
    """First pass, written: ``doc_id, part, first, doc_tokens, ids`` (4 bytes an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, first = encoder(path).encode, TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "text"):
            sizes, ids = encode(batch.column("text").to_pylist(), end)
            starts = first + np.cumsum(sizes) - sizes
            first += int(sizes.sum())
            ends = np.concatenate([[0], np.cumsum(sizes * 4)]).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<i4"))])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.full(len(sizes), part, np.int32)), pa.array(starts), pa.array(sizes), column],
                ["doc_id", "part", "first", "doc_tokens", "ids"])

    spark = df.sparkSession
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, part int, first long, doc_tokens long, ids binary"
    out = stage_path(spark, "ids")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(out)
    return spark.read.schema(schema).parquet(out)


def pack(df: DataFrame, path: str, length: int = 1024, end: int = 0) -> DataFrame:
    """Pieces: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (binary)."""
    docs = encoded(df, path, end)
    totals = docs.groupBy("part").agg(F.max(F.col("first") + F.col("doc_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    few = docs.select("part").distinct().count() <= SENT_TOTALS
    placed = docs.join(F.broadcast(bases) if few else bases, "part").withColumn("at", F.col("base") + F.col("first"))
    n = F.lit(length).cast("long")
    cut = placed.withColumn(
        "sequence_id",
        F.explode(F.sequence(F.floor(F.col("at") / n), F.floor((F.col("at") + F.col("doc_tokens") - 1) / n))))
    cut = cut.withColumn("start", F.greatest(F.col("sequence_id") * n - F.col("at"), F.lit(0)))
    cut = cut.withColumn(
        "length", F.least((F.col("sequence_id") + 1) * n - F.col("at"), F.col("doc_tokens")) - F.col("start"))
    return cut.select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * n).alias("offset"),
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"))
