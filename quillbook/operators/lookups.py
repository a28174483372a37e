"""Reference lookups: equality, wildcard best match, include/exclude."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbook.functions.codes import AMBIGUOUS, MISSING, WILDCARD
from quillbook.functions.groups import neighbour
from quillbook.session import control_table, materialise


def look_up(rows: DataFrame, subledgers: DataFrame, ledgers: DataFrame, reinsurance: DataFrame) -> DataFrame:
    """Left join the three ledger lookups on codes computed from the row.

    No broadcast hint: the lookups are tables of known size, so Spark
    broadcasts them when they are small and shuffles when they are not.
    """
    return (
        rows.join(
            subledgers,
            (rows["gl_application_area_code"] == subledgers["_area"])
            & (F.substring(rows["gl_source_code"], 1, 3) == subledgers["_source"]),
            "left",
        )
        .join(
            ledgers,
            (F.substring(rows["secondary_ledger_code"], 3, 2) == ledgers["_ledger"])
            & (rows["secondary_ledger_code"] == ledgers["_company"]),
            "left",
        )
        .join(
            reinsurance,
            (F.substring(rows["secondary_ledger_code"], 1, 2) == reinsurance["legal_entity"])
            & (rows["orig_gl_center"] == reinsurance["center_code"]),
            "left",
        )
        .drop("_area", "_source", "_ledger", "_company", "legal_entity", "center_code")
    )


def is_included(*flags: str) -> Column:
    """True unless one of the lookups says otherwise; a missing lookup includes."""
    tests = [F.coalesce(F.col(f), F.lit("Include")) == "Include" for f in flags]
    return reduce(lambda a, b: a & b, tests)


def is_excluded(*flags: str) -> Column:
    tests = [F.coalesce(F.col(f), F.lit("Include")) == "Exclude" for f in flags]
    return reduce(lambda a, b: a | b, tests)


def one_or_ambiguous(lookup: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key: its value, or ``Q`` where the key has several values. Nulls do not count."""
    count = F.count(value)
    return lookup.groupBy(*keys).agg(
        F.when(count > 1, AMBIGUOUS).otherwise(F.min(value)).alias(value))


def wildcard_match(
    rows: DataFrame,
    lookup: DataFrame,
    required: dict[str, str],
    optional: dict[str, str],
    value: str,
    message: str = "error_message",
) -> DataFrame:
    """The value of the most specific lookup row that fits each row.

    ``required`` and ``optional`` map row columns to lookup columns. An
    optional lookup column fits when it is ``-`` or equal; blank and ``NA``
    row values fit ``-`` only. A null lookup column is no condition at all.
    Where the required columns alone name a single lookup row, that row fits
    regardless of its optional columns. Fewest wildcards win, unambiguous
    before ``Q``; ``@`` where nothing fits, null and a message where only an
    ambiguous row does.

    Lookup rows ask for different sets of columns (their mask: wildcard, null
    or value). A row's combination of values meets the masks that its required
    values have in the lookup, those that ask for none of the columns it has no
    usable value in; for each it is looked up by the digest of the columns
    asked for. So only pairs that fit are formed, combinations do not grow
    with copies of rows, and the best match is a partial aggregate over one
    number. Digests are twice 64 bits.
    """
    columns = [*required, *optional]
    targets = [*required.values(), *optional.values()]
    choices = one_or_ambiguous(lookup, targets, value)
    wild = [F.when(F.col(c) == WILDCARD, 1).otherwise(0) for c in optional.values()]
    choices = choices.withColumn("_wildcards", reduce(lambda a, b: a + b, wild))
    # A null required column is no condition either, so a row stands alone if no other fits the same values.
    alone = choices.groupBy(*[F.col(c).alias(f"_s_{c}") for c in required.values()]).agg(
        (F.count(F.lit(1)) == 1).alias("_alone"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in required.values()])
    choices = choices.join(alone, same)

    def asks(c: str) -> Column:
        some = F.col(c).isNotNull()
        return some if c in required.values() else some & (F.col(c) != WILDCARD) & ~F.col("_alone")

    def digest(i: int, text: Column) -> list[Column]:
        return [F.xxhash64(F.lit(i), text), F.xxhash64(F.lit(i + len(columns)), text)]

    def joined(parts: list[Column]) -> Column:
        return reduce(lambda a, b: a.bitwiseXOR(b), parts)

    nothing, ones = F.lit(0).cast("long"), range(len(required))
    asked = [F.when(asks(c), F.lit(1 << i)).otherwise(0) for i, c in enumerate(targets)]
    sums = {f"_k{h}": [F.when(asks(c), digest(i, F.col(c).cast("string"))[h]).otherwise(nothing) for i, c in enumerate(targets)] for h in (0, 1)}
    choices = control_table(choices.select(
        reduce(lambda a, b: a + b, asked).alias("_mask"), reduce(lambda a, b: a + b, [asked[i] for i in ones]).alias("_rmask"),
        *[joined(parts).alias(k) for k, parts in sums.items()], joined([sums["_k0"][i] for i in ones]).alias("_rkey"),
        F.col(value).alias("_value"), "_wildcards"))
    # What a match is worth as a number: a row per value and number of wildcards.
    worth = Window.orderBy("_wildcards", F.col("_value") == AMBIGUOUS, "_value")
    ranks = control_table(choices.select("_wildcards", "_value").distinct().withColumn("_rank", F.row_number().over(worth)))
    same_worth = choices["_wildcards"].eqNullSafe(ranks["_wildcards"]) & choices["_value"].eqNullSafe(ranks["_value"])
    choices = control_table(choices.join(ranks, same_worth).select("_mask", "_rmask", "_rkey", "_k0", "_k1", "_rank"))
    # The masks of each combination of required values: at most 2 ** columns of them.
    masks = control_table(choices.groupBy("_rmask", "_rkey").agg(F.collect_set("_mask").alias("_masks")))

    def usable(c: str) -> Column:
        text = F.col(c).cast("string")
        return text if c in required else F.when(~F.trim(text).isin("", "NA"), text)

    combos = materialise(rows.select(*columns).distinct().withColumn("_id", F.monotonically_increasing_id()), "combinations")
    known = [F.when(usable(c).isNotNull(), F.lit(1 << i)).otherwise(0) for i, c in enumerate(columns)]
    hashed = combos.select("_id", reduce(lambda a, b: a + b, known).alias("_known"), *[
        d.alias(f"_h{h}_{i}") for i, c in enumerate(columns) for h, d in enumerate(digest(i, usable(c)))])

    def looked_up(mask: str, h: int, among: range) -> Column:
        return joined([F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.col(f"_h{h}_{i}")).otherwise(nothing) for i in among])

    def answered(mask: str) -> Column:
        return F.col(mask).bitwiseAND(F.bitwise_not("_known")) == 0

    met = hashed.withColumn("_rmask", F.explode(F.lit(list(range(1 << len(required)))))).where(answered("_rmask"))
    met = met.withColumn("_rkey", looked_up("_rmask", 0, ones)).join(masks, ["_rmask", "_rkey"])
    met = met.withColumn("_mask", F.explode("_masks")).where(answered("_mask"))
    met = met.select("_id", "_mask", *[looked_up("_mask", h, range(len(columns))).alias(f"_k{h}") for h in (0, 1)])
    best = met.join(choices, ["_mask", "_k0", "_k1"]).groupBy("_id").agg(F.min("_rank").alias("_rank"))
    best = best.join(ranks.select("_rank", F.col("_value").alias("_best")), "_rank")
    best = combos.join(best, "_id").select(*[F.col(c).alias(f"_r_{c}") for c in columns], "_best")
    on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(F.col(f"_r_{c}")) for c in columns])
    first, second = list(required)[:2]
    ambiguous = F.concat(
        F.lit("Cash flow type ambiguous for event type code ("), F.coalesce(F.col(first), F.lit("")),
        F.lit(") and transaction class ("), F.coalesce(F.col(second), F.lit("")), F.lit(");"))
    return rows.join(best, on, "left").select(
        *[rows[c] for c in rows.columns],
        F.when(F.col("_best") == AMBIGUOUS, None).otherwise(F.coalesce("_best", F.lit(MISSING))).alias(value),
        F.when(F.col("_best") == AMBIGUOUS, ambiguous).alias(message),
    )


def same_rows_present(df: DataFrame, other: DataFrame, keys: list[str], missing: bool = False) -> DataFrame:
    """Rows whose key is (or is not) in another table."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti" if missing else "left_semi")


def as_of(rows: DataFrame, versions: DataFrame, on: list[str], when: str, start: str, stop: str) -> DataFrame:
    """The version in force at ``when``. Versions of a key must not overlap.

    Rows and versions are put in one order per key and each row takes the last
    version before it. A join on the key would pair every row of a key with
    every version of it before the dates are looked at.
    """
    fields = [c for c in versions.columns if c not in on]
    kind = versions.schema[start].dataType
    row_type = rows.select(F.struct(*rows.columns).alias("r")).schema["r"].dataType
    version = versions.select(
        *on, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.struct(*fields).alias("_version"),
        F.lit(None).cast(row_type).alias("_row"))
    version_type = version.schema["_version"].dataType
    wanted = rows.select(
        *on, F.col(when).cast(kind).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(version_type).alias("_version"), F.struct(*rows.columns).alias("_row"))
    placed = neighbour(
        version.unionByName(wanted), on, ["_at", "_kind"], "_found", F.col("_version"), among=F.col("_kind") == 0)
    in_force = F.col("_at") <= F.col(f"_found.{stop}")
    return placed.where(F.col("_kind") == 1).select(
        "_row.*", *[F.when(in_force, F.col(f"_found.{c}")).alias(c) for c in fields])


def _day(when: Column, up: bool = False) -> Column:
    """Number of the day; ``up``: of the first midnight that is not before ``when``."""
    day = F.unix_date(when.cast("date"))
    return day + F.when(when.cast("timestamp") > when.cast("date").cast("timestamp"), 1).otherwise(0) if up else day


def in_force_on(versions: DataFrame, days: DataFrame, on: list[str], start: str, stop: str, day: str) -> DataFrame:
    """Every version with every row of ``days`` on whose date it is in force; both have the columns ``on``.

    Equality on ``on`` alone would pair all versions of a source system with
    all its dates. Here the span of the dates is laid out as a binary tree of
    cells: a validity is cut into the fewest cells that make it up (at most two
    a level), a date looks up the one cell of each level that it lies in, and
    the two meet by equality of the cell. The cells of a validity do not
    overlap, so every pair is formed once. ``days`` is a control table, a few
    rows per source system; versions outside its span go first.
    """
    span = days.agg(F.min(_day(F.col(day))).alias("low"), F.max(_day(F.col(day))).alias("high")).first()
    low, high = (span["low"], span["high"]) if span["low"] is not None else (0, -1)
    levels = max(high - low, 0).bit_length()
    first = F.greatest(_day(F.col(start), up=True) - low, F.lit(0))
    end = F.least(_day(F.col(stop)) - low, F.lit(high - low)) + 1
    none = F.array().cast("array<struct<level:int,cell:int>>")

    def climb(s: Column, level: Column) -> Column:
        a, b = s["a"], s["b"]
        left, right = a < b, (a < b) & (b % 2 == 1)
        left = left & (a % 2 == 1)
        cell = lambda c: F.array(F.struct(level.alias("level"), c.cast("int").alias("cell")))
        found = F.concat(s["cells"], F.when(left, cell(a)).otherwise(none), F.when(right, cell(b - 1)).otherwise(none))
        up = lambda c: F.shiftright(c, 1)
        return F.struct(up(F.when(left, a + 1).otherwise(a)).alias("a"), up(F.when(right, b - 1).otherwise(b)).alias("b"), found.alias("cells"))

    begin = F.struct(first.alias("a"), end.alias("b"), none.alias("cells"))
    cells = F.aggregate(F.sequence(F.lit(0), F.lit(levels)), begin, climb)["cells"]
    known = F.col(start).isNotNull() & F.col(stop).isNotNull() & (first < end)
    pieces = versions.where(known).withColumn("_c", F.explode(cells))
    pieces = pieces.select(*versions.columns, F.col("_c.level").alias("_level"), F.col("_c.cell").alias("_cell"))
    above = days.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    above = control_table(above.withColumn("_cell", F.expr(f"cast(shiftright(unix_date(cast(`{day}` as date)) - {low}, _level) as int)")))
    return pieces.join(above, [*on, "_level", "_cell"]).drop("_level", "_cell")


def listed(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per non-empty entry of a comma separated list."""
    return df.withColumn(name, F.explode(F.split(column, ","))).withColumn(name, F.trim(name)).where(F.col(name) != "")


def ranked(df: DataFrame, partition: list[str], order: list[str], name: str) -> DataFrame:
    """``dense_rank`` over a control table, which has one row per batch."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*partition).orderBy(*order)))
