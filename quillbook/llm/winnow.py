"""Document fingerprints by winnowing, and the row that follows each row.

A text is cut into pieces at borders that the text itself sets: a run of at
most ``WORD`` code points between white space is a piece; in a longer run, as
texts without blanks have them, every code point with the one behind it is a
piece, so that nothing shifts when one is put in. A text of at most ``SHORT``
code points, too short for several hashes of words, is read in such pairs as a
whole. Every k pieces in a row are hashed; of every w hashes in a row the smallest is chosen, the rightmost one of
equals, with its position. Two texts that share k + w - 1 pieces in a row
therefore share a chosen hash. A text of fewer than k pieces is hashed whole; a
text of fewer than w hashes has one window; a text without pieces (null, empty,
white space) has no hashes, and two such fingerprints are alike (1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD, SHORT = 16, 160
_WHOLE = rf"(?<!\S)\S{{1,{WORD}}}(?!\S)"
#: The piece is what the look-ahead finds; of a longer run one code point is passed over at a time.
PIECE = rf"(?=({_WHOLE}|\S{{1,2}}))(?:{_WHOLE}|\S)"
PAIR = r"(?=(\S{1,2}))\S"
K, W = 3, 4
#: Runs for each partition of a shuffle.
RUNS = 4


def _pack(h: Column, i: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(h, 33), 32).bitwiseOR((F.lit(2147483647) - i).cast("long"))


def _unpack(v: Column) -> Column:
    return F.struct(
        (F.lit(2147483647).cast("long") - v.bitwiseAND(F.lit(4294967295))).cast("int").alias("pos"),
        F.shiftright(v, 32).alias("hash"))


def _window_minima(packed: str, w: int) -> list[tuple[str, Column]]:
    """Steps that turn ``packed`` into the minima of its windows, each from those of windows of half the size."""
    steps, size = [], 1
    while size < w:  # a text of fewer hashes has one window: its steps leave at least one minimum
        step = min(size, w - size)
        left = F.greatest(F.size(packed) - F.lit(step), F.lit(0))
        pairs = F.zip_with(F.slice(packed, F.lit(1), left), F.slice(packed, F.lit(step + 1), left), lambda x, y: F.least(x, y))
        steps.append((packed, F.when(F.size(packed) > step, pairs).when(F.size(packed) == 0, F.col(packed)).otherwise(
            F.array(F.array_min(packed)))))
        size += step
    return steps


def fingerprints(df: DataFrame, text: str, into: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with ``into``: an array of (pos, hash) in the order of the text; hashes have 31 bits.

    A hash and its position are packed into one number whose order is hash
    first and later position first, so the least of a window is the choice.
    """
    tokens, packed = f"_{into}_tokens", f"_{into}_packed"
    own = F.coalesce(F.col(text), F.lit(""))
    cut = lambda pattern: F.regexp_extract_all(own, F.lit(pattern), F.lit(1))
    pieces = F.when(F.length(own) <= SHORT, cut(PAIR)).otherwise(cut(PIECE))
    df = df.withColumn(tokens, F.transform(pieces, lambda t: F.xxhash64(t)))
    n = F.size(tokens)
    whole = F.array(_pack(F.xxhash64(tokens), F.lit(0)))
    each = F.transform(F.sequence(F.lit(0), n - F.lit(k)),
                       lambda i: _pack(F.xxhash64(*[F.get(F.col(tokens), i + F.lit(j)) for j in range(k)]), i))
    df = df.withColumn(packed, F.when(n == 0, F.expr("array()").cast("array<bigint>")).when(n < k, whole).otherwise(each))
    for name, step in _window_minima(packed, w):
        df = df.withColumn(name, step)
    return df.withColumn(into, F.transform(F.array_distinct(packed), _unpack)).drop(tokens, packed)


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct hashes (arrays of distinct numbers) that both have, of those that either has."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def as_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda h: F.lower(F.hex(h))), " ")


def in_runs(df: DataFrame, key: str, tie: Column) -> tuple[DataFrame, Window]:
    """Rows dealt into runs of descending ``key``, then ``tie`` (a number), each with the first row of the next run as a guest.

    The borders of the runs are the least rows of as many range partitions of
    key and tie alone; every row finds its run by bisection. A run is one
    window partition, so the rows themselves are shuffled once, into a stated
    number of partitions since the work on them is more than their size tells,
    and ``lead`` works in every run on its own. The last run's guest is the very
    first row. ``_guest`` marks the copies. Rows that agree in key and tie share a run.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The complement of an id falls as the id rises; rows without id come last.
    place = [F.col(key).isNull().cast("int").alias("a"), F.bitwise_not(F.coalesce(F.col(key), F.lit(0)).cast("long")).alias("b"),
             tie.alias("c")]
    ranged = df.select(*place).repartitionByRange(RUNS * partitions, "a", "b", "c")
    least = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("a", "b", "c")).alias("p"))
    borders = sorted(tuple(r["p"]) for r in least.collect()) or [(0, 0, 0)]  # three numbers per run
    columns = [F.lit([b[i] for b in borders]) for i in range(3)]
    border = lambda i: F.struct(*[F.get(c, i).alias(n) for c, n in zip(columns, "abc", strict=True)])
    steps = [1 << k for k in reversed(range(len(borders).bit_length()))]
    own = F.col("_place")
    reached = F.aggregate(F.lit(steps), F.lit(0), lambda n, s: F.when(
        (n + s <= len(borders)) & (border(n + s - 1) <= own), n + s).otherwise(n))
    placed = df.withColumn("_place", F.struct(*place)).withColumn("_run", F.greatest(reached - 1, F.lit(0)))
    here = F.struct(F.col("_run").alias("run"), F.lit(0).alias("guest"))
    there = F.struct(F.pmod(F.col("_run") - 1, F.lit(len(borders))).alias("run"), F.lit(1).alias("guest"))
    copies = F.when(border(F.col("_run")) == own, F.array(here, there)).otherwise(F.array(here))
    dealt = placed.withColumn("_at", F.explode(copies)).select(
        *df.columns, "_place", F.col("_at.run").alias("_run"), F.col("_at.guest").alias("_guest"))
    return dealt.repartition(partitions, "_run"), Window.partitionBy("_run").orderBy("_guest", "_place")
