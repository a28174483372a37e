"""Numbering and neighbour lookup inside groups of any size.

A window puts a whole group into one task. That is right for almost every
group and wrong for one that holds a large share of all rows. The functions
here find such groups first (an exact count per key, added up before the
shuffle), window the others as usual and cut the large ones into range slices:

* rows are range partitioned by key and order, so that each slice is a
  contiguous, bounded run of a group;
* the window runs per slice;
* what crosses a slice border (rows before it, the value next to it) comes
  from a summary with at most one row per group and slice.

The slices are written once before use, so a lost executor cannot change
them. Both ways give the same result. ``df`` is read twice, so it should be a
written table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbook.session import materialise

GROUP_ROWS = "quillbook.group.rows"
DEFAULT_GROUP_ROWS = 5_000_000


def group_rows(df: DataFrame) -> int:
    """Rows of one group that a single task may hold."""
    return int(df.sparkSession.conf.get(GROUP_ROWS, str(DEFAULT_GROUP_ROWS)))


def _group_id(keys: list[str]) -> Column:
    # Collisions only send a small group the long way round.
    return F.xxhash64(*keys)


@dataclass(frozen=True)
class Large:
    """Groups that are too large for one task: a written table of their ids (none: no such group), and their rows."""

    ids: DataFrame | None = None
    rows: int = 0


def find_large(df: DataFrame, keys: list[str], within: list[DataFrame] | None = None) -> Large:
    """The groups with more rows than a task may hold, whatever their number.

    ``within`` names tables that ``df`` has no more rows than. Where these are
    small, their count settles the matter; for files it is read off the footers.
    """
    limit = group_rows(df)
    if within is not None and sum(w.count() for w in within) <= limit:
        return Large()
    counts = df.groupBy(_group_id(keys).alias("_gid")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    found = materialise(counts, "large-groups")
    rows = found.agg(F.sum("_n")).first()[0]
    return Large(found.select("_gid"), rows) if rows else Large()


def _slices(df: DataFrame, keys: list[str], order: list[str], rows: int) -> DataFrame:
    """Rows of large groups with a slice number and a tie breaker."""
    tied = materialise(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
    wanted = -(-rows // group_rows(df)) * 2
    count = max(wanted, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = tied.repartitionByRange(count, *keys, *order, "_tie")
    return materialise(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def _matches(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def _split(df: DataFrame, keys: list[str], large: Large) -> tuple[DataFrame, DataFrame | None]:
    if large.ids is None:
        return df, None
    same = _group_id(keys) == F.col("_gid")
    return df.join(large.ids, same, "left_anti"), df.join(large.ids, same, "left_semi")


def number_rows(
    df: DataFrame, keys: list[str], order: list[str], name: str, large: Large | None = None
) -> DataFrame:
    """``row_number`` per key, ascending, nulls first. Rows that tie are interchangeable.

    ``large`` is the result of :func:`find_large` where the caller has it already.
    """
    large = find_large(df, keys) if large is None else large
    plain, split = _split(df, keys, large)
    numbered = plain.withColumn(
        name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    if split is None:
        return numbered
    sliced = _slices(split, keys, order, large.rows)
    local = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_slice", *keys).orderBy(*order, "_tie")))
    sizes = sliced.groupBy("_slice", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", *keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # One row per group and slice; written, so that the planner knows its size.
    starts = materialise(starts, "starts")
    joined = local.join(starts, _matches(local, starts, ["_slice", *keys]), "left")
    done = joined.select(*[local[c] for c in df.columns], (F.col("_local") + F.col("_start")).alias(name))
    return numbered.unionByName(done)


def neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    value: Column,
    following: bool = False,
    among: Column | None = None,
    large: Large | None = None,
) -> DataFrame:
    """``lag`` (or ``lead`` if ``following``) of ``value`` per key.

    With ``among``, only rows for which it holds count as neighbours. ``order``
    must be total within a key.
    """
    among = F.lit(True) if among is None else among
    # The struct keeps a null value apart from a missing neighbour.
    boxed = F.when(among, F.struct(value.alias("v")))

    def ordered(extra: tuple[str, ...] = ()) -> list[Column]:
        return [F.desc(c) if following else F.asc(c) for c in (*order, *extra)]

    def nearest(by: list[str], sort: list[Column], of: Column) -> Column:
        window = Window.partitionBy(*by).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(of, ignorenulls=True).over(window)

    large = find_large(df, keys) if large is None else large
    plain, split = _split(df, keys, large)
    result = plain.withColumn(name, nearest(keys, ordered(), boxed)["v"])
    if split is None:
        return result
    sliced = _slices(split, keys, order, large.rows).withColumn("_box", boxed)
    local = sliced.withColumn("_near", nearest(["_slice", *keys], ordered(("_tie",)), F.col("_box")))
    # The outermost neighbour of each group and slice, passed on to the next slices.
    position = F.struct(*order, "_tie")
    pick = F.min_by if following else F.max_by
    edges = sliced.where(F.col("_box").isNotNull()).groupBy("_slice", *keys).agg(
        pick(F.col("_box"), position).alias("_edge"))
    borders = sliced.select("_slice", *keys).distinct()
    borders = borders.join(edges, _matches(borders, edges, ["_slice", *keys]), "left").select(
        *[borders[c] for c in ("_slice", *keys)], edges["_edge"])
    toward = [F.desc("_slice") if following else F.asc("_slice")]
    borders = borders.select("_slice", *keys, nearest(keys, toward, F.col("_edge")).alias("_passed"))
    borders = materialise(borders, "borders")
    joined = local.join(borders, _matches(local, borders, ["_slice", *keys]), "left")
    done = joined.select(
        *[local[c] for c in df.columns], F.coalesce(local["_near"], borders["_passed"])["v"].alias(name))
    return result.unionByName(done)
