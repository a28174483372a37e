"""Shards along a Hilbert curve.

Metadata columns are quantised to cells of about equal counts (at most
2**bits boundaries each, found approximately and sent to the tasks), the cells
are numbered along a Hilbert curve, and rows are sorted by that number. Runs of
the sorted rows are the shards: counts differ by one at most, and rows near
each other in several dimensions share files, so that minima and maxima prune.

Equal texts are one group: they take the least metadata of the group, and the
text's digest is the next sort key, so a group is cut only where a shard ends.
Rows are range partitioned by all sort keys, so a group of any size spreads
over tasks, and ranks come from the partitions' counts. Null metadata sort
first; repeated rows take places of their own. Files hold every row once: rows
of one id and text (or without id) are numbered, and so are their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbook.functions.groups import number_rows
from quillbook.session import materialise

BITS = 6
ACCURACY = 1000


def as_number(c: Column) -> Column:
    """The first six bytes of a string as a number of the same order."""
    padded = F.rpad(F.hex(F.substring(F.coalesce(c, F.lit("")).cast("binary"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("double")


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (rows, dimensions) on the Hilbert curve: Skilling's transform."""
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(n):
            set_ = (x[d] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
        q >>= 1
    for d in range(1, n):
        x[d] ^= x[d - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x = [v ^ turn for v in x]
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << 1) | ((v >> b) & 1)
    return out


def _content(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def _text_hashes(text: str) -> list[Column]:
    return [F.xxhash64(_content(text)).alias("t1"), F.hash(_content(text)).alias("t2")]


def hilbert_shards(
    df: DataFrame, dimensions: dict[str, Column], shards: int, key: str = "doc_id", text: str = "text", bits: int = BITS
) -> DataFrame:
    """``doc_id, size, text_crc32, t1, t2, curve, shard, slot`` of every row; ``dimensions`` are numbers by name.

    ``t1`` and ``t2`` are hashes of the text.
    """
    names = list(dimensions)
    if not names or len(names) * bits > 62:
        raise ValueError("between one dimension and 62 bits")
    content = _content(text)
    base = df.select(
        F.col(key).cast("long").alias("doc_id"), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"), *_text_hashes(text),
        *[F.coalesce(c.cast("double"), F.lit(float("-inf"))).alias(f"_{n}") for n, c in dimensions.items()])
    base = materialise(base.withColumn("tie", F.monotonically_increasing_id()), "metadata")
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = base.agg(*[F.percentile_approx(f"_{n}", steps, ACCURACY).alias(n) for n in names]).first()
    bounds = [np.unique(np.array(cuts[n] or [0.0])) for n in names]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.stack([np.searchsorted(b, batch.column(f"_{n}").to_numpy(zero_copy_only=False), "left")
                              for n, b in zip(names, bounds, strict=True)], axis=1)
            yield pa.record_batch([batch.column("t1"), batch.column("t2"), pa.array(curve_index(cells, bits))],
                                  ["t1", "t2", "curve"])

    groups = base.groupBy("t1", "t2").agg(*[F.min(f"_{n}").alias(f"_{n}") for n in names])
    curve = groups.mapInArrow(numbered, "t1 long, t2 int, curve long")
    order = ["curve", "t1", "t2", "doc_id", "tie"]
    rows = base.drop(*[f"_{n}" for n in names]).join(curve, ["t1", "t2"])
    ranged = materialise(rows.repartitionByRange(*order).withColumn("run", F.spark_partition_id()), "runs")
    counts = ranged.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    first = materialise(counts.select(
        "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy()).alias("all")),
        "firsts")
    local = F.row_number().over(Window.partitionBy("run").orderBy(*order)) - 1
    ranked = ranged.withColumn("local", local).join(first, "run").withColumn("rank", F.col("first") + F.col("local"))
    placed = ranked.withColumn("shard", F.expr(f"cast(rank * {shards}L div all as int)"))
    start = F.expr(f"(shard * all + {shards - 1}L) div {shards}L")
    return placed.select("doc_id", "size", "text_crc32", "t1", "t2", "curve", "shard", (F.col("rank") - start).cast("long").alias("slot"))


def write_shards(df: DataFrame, placed: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Files by shard, rows of a file next to each other on the curve; statistics in the footers prune them.

    Rows of one id and text have neighbouring places, so any of them may take any of these.
    """
    same = ["_id", "_t1", "_t2"]
    own = df.withColumns({"_id": F.col(key).cast("long"), **dict(zip(same[1:], _text_hashes(text), strict=True))})
    # Written, so that each row keeps its number however often a task runs.
    rows = materialise(own.select(F.struct(*df.columns).alias("row"), *same), "rows")
    at = placed.select(*[F.col(c).alias(a) for c, a in zip(["doc_id", "t1", "t2"], same, strict=True)], "shard", "slot")
    rows = materialise(number_rows(rows, same, same, "_n"), "numbered")
    at = materialise(number_rows(materialise(at, "places"), same, ["shard", "slot"], "_n"), "numbered-places")
    at = at.select(*[F.col(c).alias(f"{c}_at") for c in (*same, "_n")], "shard", "slot")
    met = [F.col(c).eqNullSafe(F.col(f"{c}_at")) for c in (*same, "_n")]
    rows = rows.join(at, reduce(Column.__and__, met)).select("row.*", "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
