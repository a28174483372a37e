"""The text columns of a row as one text, for shuffles and sorts.

A row with many short texts is mostly their offsets, lengths and padding.
Joined into one text it takes less than half of that, and gives back every
text and null as it was.

The text sorts as its columns do, one after the other, nulls first: a column
ends with a character lower than any a text keeps, as those are escaped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKED = "_packed"
NULL, END, ESCAPE = "\x00", "\x01", "\x02"
# The escape itself goes first and comes back last.
ESCAPED = {ESCAPE: ESCAPE + "C", NULL: ESCAPE + "A", END: ESCAPE + "B"}


def text_columns(df: DataFrame, first: list[str]) -> list[str]:
    """All text columns, those of ``first`` in front."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return [*first, *[c for c in texts if c not in first]]


def _escaped(c: Column) -> Column:
    return reduce(lambda v, low: F.replace(v, F.lit(low), F.lit(ESCAPED[low])), ESCAPED, c)


def _as_it_was(c: Column) -> Column:
    return reduce(lambda v, low: F.replace(v, F.lit(ESCAPED[low]), F.lit(low)), reversed(ESCAPED), c)


def pack(df: DataFrame, texts: list[str]) -> DataFrame:
    """``df`` with the column ``PACKED`` in place of its ``texts``."""
    def known(c: Column) -> Column:
        return F.coalesce(c, F.lit(NULL))

    together = F.concat_ws("", *texts)
    low = reduce(lambda a, b: a | b, [F.contains(together, F.lit(c)) for c in ESCAPED])
    packed = F.when(low, F.concat_ws(END, F.transform(F.array(*texts), lambda c: known(_escaped(c))), F.lit(""))).otherwise(
        F.concat_ws(END, *[known(F.col(c)) for c in texts], F.lit("")))
    return df.select(*[c for c in df.columns if c not in texts], packed.alias(PACKED))


def unpack(df: DataFrame, texts: list[str]) -> DataFrame:
    """``df`` with the ``texts`` that :func:`pack` joined."""
    # Splitting decodes the text, so bytes that are no UTF-8 take the way that only compares them.
    odd = F.contains(PACKED, F.lit(ESCAPE)) | ~F.is_valid_utf8(PACKED)

    def one(i: Column) -> Column:
        upto = F.call_function("substring_index", F.col(PACKED), F.lit(END), i)
        return _as_it_was(F.nullif(F.substring_index(upto, END, -1), F.lit(NULL)))

    each = F.transform(F.sequence(F.lit(1), F.lit(len(texts))), one)
    plain = F.split(PACKED, END)
    plain = F.when(F.contains(PACKED, F.lit(NULL)), F.transform(plain, lambda c: F.nullif(c, F.lit(NULL)))).otherwise(plain)
    split = df.withColumn(PACKED, F.when(odd, each).otherwise(plain))
    return split.select(
        *[c for c in df.columns if c != PACKED], *[F.get(PACKED, F.lit(i)).alias(c) for i, c in enumerate(texts)])
