"""Mixing sources to target weights along a curriculum.

A source's weight changes over the course of training: a schedule gives it at
some points of progress (0 to 1), straight lines lie between. Its integral is
the source's share of the mix; shares are stretched so that targets add up to
all sizes, no source is taken more than ``passes`` times, and what that leaves
over goes to the others by weight. The documents of a source stand in an order
that only depends on their content; the stream of their sizes, begun again up
to ``passes`` times, is cut at the target. A document's place in the stream is
the cumulative demand at which it is due, and the inverse of the integrated
schedule (a root in closed form on each straight line) is the progress at which
training reads it. Sorting by that position, range partitioned, is the mix.

Running sums go by source and by slices of the order (the first digits of a
digest of id and text), so no source has to fit in a task; rows that agree in
everything are counted first and dealt out again afterwards. Only the totals of
sources (one row each) are summed up in one task.

Sources rank by code point, null last. A null text has no words. Documents
without words, and those that the last, cut pass does not reach, are taken 0
words of in it. A row without id is told by its text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbook.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the digest that name a slice of a source.
DIGITS = 3


@dataclass(frozen=True)
class Schedule:
    """Weights of a source at points of progress, from 0 to 1."""

    points: tuple[tuple[float, float], ...]

    def __post_init__(self) -> None:
        at = [p for p, _ in self.points]
        if len(at) < 2 or at[0] != 0 or at[-1] != 1 or any(a >= b for a, b in zip(at, at[1:])):
            raise ValueError("a schedule needs rising points of progress from 0 to 1")
        if min(w for _, w in self.points) < 0 or max(w for _, w in self.points) <= 0:
            raise ValueError("weights are not negative and not all zero")

    def segments(self) -> list[tuple[float, float, float, float, float]]:
        """Straight lines: progress where it begins, length, weights at both ends, weight collected before."""
        out, before = [], 0.0
        for (a, v), (b, w) in zip(self.points, self.points[1:]):
            out.append((float(a), float(b - a), float(v), float(w), before))
            before += (b - a) * (v + w) / 2
        return out

    @property
    def integral(self) -> float:
        return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(self.points, self.points[1:]))


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _segment(schedule: Schedule) -> Column:
    names = ("begin", "length", "first", "last", "before")
    return F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, s, strict=True)]) for s in schedule.segments()])


def targets(sizes: DataFrame, schedules: Sequence[Schedule], passes: int) -> DataFrame:
    """``source, source_size, target, take, weight, lines`` from ``source, source_size``.

    The sources take the schedules in turn, in the order of their names. A source whose limit is low for its weight
    is full first, so the full ones are the first of that order: after some of them the rest shares what is left.
    """
    n = len(schedules)
    ranked = sizes.withColumn("_turn", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % n)
    pick = lambda each: F.element_at(F.array(*each), F.col("_turn") + 1)
    ranked = ranked.select("source", "source_size", pick([F.lit(s.integral) for s in schedules]).alias("weight"),
                           pick([_segment(s) for s in schedules]).alias("lines"))
    limit = F.col("source_size") * passes
    order = Window.orderBy(limit / F.col("weight"), F.asc_nulls_last("source"))
    all_rows, rest = Window.partitionBy(), order.rowsBetween(0, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum(limit).over(earlier), F.lit(0))
    level = (left / F.sum("weight").over(rest)).alias("_level")
    # The first source that does not reach its limit sets the level of all that follow it.
    shared = ranked.select("*", limit.alias("_limit"), level).withColumn(
        "_level", F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.col("_level")))
    level = F.first("_level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    target = F.coalesce(F.least(level * F.col("weight"), F.col("_limit")), F.col("_limit")).cast("double")
    out = shared.select("source", "source_size", target.alias("target"), "weight", "lines", "_limit")
    return out.select("source", "source_size", "target", F.least(F.floor("target"), F.col("_limit")).alias("take"), "weight", "lines")


def progress(lines: Column, collected: Column) -> Column:
    """Where the integrated schedule has reached ``collected``: the inverse on its straight line."""
    line = F.element_at(F.filter(lines, lambda s: s["before"] <= collected), -1)
    rest, slope = collected - line["before"], (line["last"] - line["first"]) / line["length"]
    root = line["first"] + F.sqrt(F.greatest(line["first"] * line["first"] + 2 * slope * rest, F.lit(0.0)))
    step = F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / root)
    return F.least(line["begin"] + F.least(step, line["length"]), F.lit(1.0))


def mixed(
    df: DataFrame, schedules: Sequence[Schedule], passes: int = 3, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """A row per document: ``doc_id, size, source, source_size, target, taken, places``.

    ``places`` has a struct per pass: ``pass``, ``words`` (of the document, from its beginning), ``position``.
    """
    name = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"),
                     F.md5(name.cast("binary")).alias("name"))
    kept = materialise(rows.groupBy("source", "name", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
                       .withColumn("slice", F.substring("name", 1, DIGITS)), "sizes")
    size = F.col("size") * F.col("copies")
    slices = materialise(kept.groupBy("source", "slice").agg(F.sum(size).alias("total")), "slices")
    totals = slices.groupBy("source").agg(F.sum("total").alias("source_size"))
    aims = targets(totals, schedules, passes)
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begun = slices.select("source", "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # A source has at most 16 ** DIGITS slices.
    placed = materialise(begun.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
                         .drop("_source"), "begun")
    inside = Window.partitionBy("source", "slice").orderBy("name", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = kept.withColumn("ahead", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    other = placed.select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), "base", "source_size", "target", "take", "weight", "lines")
    joined = summed.join(other, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")))
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    copies = copies.withColumn("at", F.col("base") + F.col("ahead") + F.col("copy") * F.col("size"))

    def place(number: Column) -> Column:
        due = number * F.col("source_size") + F.col("at")
        taken = F.greatest(F.least(F.col("take") - due, F.col("size")), F.lit(0).cast("long"))
        # The middle of what is taken is due when the schedule has collected its share of the source's weight.
        share = F.col("weight") * ((due + taken / 2) / F.greatest(F.col("take"), F.lit(1)))
        return F.struct(number.alias("pass"), taken.alias("words"), progress(F.col("lines"), share).alias("position"))

    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(passes - 1).cast("long")), place)
    found = copies.withColumn("places", F.filter(every, lambda p: p["words"] > 0))
    taken = F.aggregate("places", F.lit(0).cast("long"), lambda t, p: t + p["words"])
    return found.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"), "places", "name", "copy")


def in_order(found: DataFrame) -> DataFrame:
    """The documents by the position at which they are read first; those that are not read come last."""
    first = F.get("places", F.lit(0))["position"]
    rows = found.withColumn("position", first)
    return rows.orderBy(F.asc_nulls_last("position"), "name", "copy")


def curriculum(found: DataFrame) -> DataFrame:
    """A row per reading, in the order of training: ``position, doc_id, source, pass, words``."""
    rows = found.select("doc_id", "source", "name", "copy", F.explode("places").alias("p"))
    return rows.orderBy("p.position", "name", "copy", "p.pass").select(
        F.col("p.position").alias("position"), "doc_id", "source", F.col("p.pass").alias("pass"), F.col("p.words").alias("words"))
