"""Company trees: level paths and the leaves below a node, at any depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quillbook.session import materialise


def level_paths(nodes: DataFrame, extra: list[str]) -> DataFrame:
    """Every node reachable from a root with the names on its path as columns.

    There are as many level columns as the deepest path has levels. A node
    with several parents is listed once per path. Raises ``ValueError`` where
    a node lies below itself.

    A row starts with the path of one node, itself, and the node above. In
    each round the paths that have not reached a root are put below those of
    the node above, of whatever length these are by then, so paths double: a
    tree of depth d takes log2(d) rounds. Rows that have reached a root are
    written once and only looked up from then on.
    """
    columns = ["name", "parent", *extra, "cycle_date"]
    step = F.struct(F.col("name").alias("name"), F.col("description_us").cast("string").alias("label"))
    names = F.transform("_path", lambda s: s["name"])
    # Named by a path from a root where there is one.
    looped = F.when(F.size(names) > F.size(F.array_distinct(names)), F.concat(
        F.col("_top").isNull().cast("int").cast("string"), F.array_join(names, " > ")))
    parts, deepest = [], 1
    longer = nodes.select(*columns, F.col("parent").alias("_top"), F.array(step).alias("_path"))
    while True:
        seen = Observation()
        own = materialise(longer.observe(
            seen, F.count("_top").alias("left"), F.max(looped).alias("loop"),
            F.max(F.when(F.col("_top").isNull(), F.size("_path"))).alias("depth")), "paths")
        if seen.get["loop"] is not None:
            raise ValueError(f"a node lies below itself: {seen.get['loop'][1:]}")
        done, going = own.where(F.col("_top").isNull()), own.where(F.col("_top").isNotNull())
        parts.append(done)
        deepest = max(deepest, seen.get["depth"] or 0)
        if not seen.get["left"]:
            break
        above = reduce(DataFrame.unionByName, [*parts, going]).select(
            F.col("name").alias("_top"), "cycle_date", F.col("_path").alias("_above"), F.col("_top").alias("_next"))
        longer = going.join(above, ["_top", "cycle_date"]).select(
            *columns, F.col("_next").alias("_top"), F.concat("_above", "_path").alias("_path"))
    everything = reduce(DataFrame.unionByName, parts)
    return everything.select(*columns, F.size("_path").alias("level"), *[
        F.get("_path", F.lit(i))["label"].alias(f"level_{i + 1}") for i in range(deepest)])


def leaves_below(nodes: DataFrame, description: str) -> DataFrame:
    """Descendants of a named node (and the node) that allow posting.

    A node is listed under each of its parents that lie below the named one.
    Goes on until a level brings no new pair of node and parent in a cycle, at
    any depth; so a loop in the data ends too.
    """
    key = ["name", "parent", "cycle_date"]
    nodes = materialise(nodes, "nodes")
    found = materialise(nodes.where(F.col("description_us") == description), "level")
    level = found
    while True:
        up = level.select(F.col("name").alias("_up"), F.col("cycle_date").alias("_cycle")).distinct()
        below = nodes.join(
            up, (F.col("parent") == F.col("_up")) & F.col("cycle_date").eqNullSafe(F.col("_cycle")), "left_semi")
        met = found.select(*[F.col(k).alias(f"_{k}") for k in key])
        same = reduce(lambda a, b: a & b, [below[k].eqNullSafe(F.col(f"_{k}")) for k in key])
        level = materialise(below.join(met, same, "left_anti"), "level")
        if level.isEmpty():
            return found.where(F.col("allow_posting").cast("string") == "1")
        found = found.unionByName(level)
