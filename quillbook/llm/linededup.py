"""Lines that repeat across documents, as keep bitmaps instead of texts.

Every line is reduced to a hash of its key (the line without white space at
both ends, A-Z in lower case). Hashes are range partitioned by hash and
document, so that a hash with very many documents spans several tasks while
the lines of one document under one hash stay together, and sorted by
document and position. One pass over each sorted run marks the first line of
every document; counting those gives the documents of a hash, and the least
of them is the first occurrence. What comes back per document is a sparse
bitmap: 64 lines a word, words of lines that all stay are left out.

A null text is one empty line. Keys shorter than ``min_chars`` are never
dropped. Rows of one id are one document (rows without an id, too); rows that
agree in id and text get the same bitmap. Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbook.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "\t\n\x0b\f\r "
KEY = ["_h1", "_h2"]


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _lower(text: Column) -> Column:
    """A-Z in lower case; an ASCII text takes the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 1) -> DataFrame:
    """A row per line: hash of its key, document and position. 96 bits keep different keys apart."""
    rows = df.select(
        F.col(key).alias("_doc"), F.xxhash64(_text(text)).alias("_text"),
        F.posexplode(F.split(_lower(_text(text)), "\n", -1)).alias("_pos", "_line"))
    rows = rows.withColumn("_line", F.btrim("_line", F.lit(SPACE))).where(F.length("_line") >= min_chars)
    return rows.select(F.xxhash64("_line").alias("_h1"), F.hash("_line").alias("_h2"), "_doc", "_text", "_pos")


def keep_bitmaps(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep: str = "none"
) -> DataFrame:
    """``_doc, _text, keep, n_dropped`` of the documents that lose lines.

    A line goes when its key is in at least ``min_docs`` documents; with
    ``keep="first"`` its first occurrence by document and position stays.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    order = ["_doc", "_text", "_pos"]
    ranged = lines(df, key, text, min_chars).repartitionByRange(*KEY, "_doc")
    runs = materialise(ranged.withColumn("_run", F.spark_partition_id()).sortWithinPartitions(*KEY, *order), "lines")
    stream = Window.partitionBy("_run").orderBy(*KEY, *order)
    before = F.lag(F.struct(*KEY, "_doc")).over(stream)
    marked = runs.withColumn("_first", ~before.eqNullSafe(F.struct(*KEY, "_doc")))
    seen = marked.where("_first").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_docs"), F.min(F.struct(*order)).alias("_at"))
    repeated = materialise(seen.where(F.col("_docs") >= min_docs), "repeated")
    dropped = runs.join(repeated, KEY)
    if keep == "first":
        dropped = dropped.where(~F.struct(*order).eqNullSafe(F.col("_at")))
    words = dropped.groupBy("_doc", "_text", F.expr("_pos div 64").cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _pos % 64)")).alias("_bits"), F.count_distinct("_pos").alias("_n"))
    return words.groupBy("_doc", "_text").agg(
        F.map_from_entries(F.collect_list(F.struct("_word", F.bitwise_not("_bits")))).alias("keep"),
        F.sum("_n").alias("n_dropped"))


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with the kept lines as text, and ``n_lines``, ``n_dropped`` as structs."""
    rows = df.withColumn("_text", F.xxhash64(_text(text)))
    joined = rows.join(bitmaps, rows[key].eqNullSafe(bitmaps["_doc"]) & (rows["_text"] == bitmaps["_text"]), "left")
    whole = F.split(_text(text), "\n", -1)

    def stays(_: Column, i: Column) -> Column:
        bits = F.coalesce(F.element_at(bitmaps["keep"], F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(bits, i % 64) == 1

    kept = F.when(bitmaps["keep"].isNull(), F.col(text)).otherwise(F.array_join(F.filter(whole, stays), "\n"))
    lines_of = (F.length(_text(text)) - F.length(F.replace(_text(text), F.lit("\n"), F.lit(""))) + 1).cast("long")
    count = F.struct(lines_of.alias("n_lines"), F.coalesce(bitmaps["n_dropped"], F.lit(0).cast("long")).alias("n_dropped"))
    return joined.select(*[kept.alias(c) if c == text else rows[c] for c in df.columns], count.alias("_lines"))


def drop_repeated_lines(df: DataFrame, **options) -> DataFrame:
    """``df`` without the lines that repeat; see :func:`keep_bitmaps`. Adds ``_lines`` (a struct of two counts)."""
    names = {k: options[k] for k in ("key", "text") if k in options}
    return apply_bitmaps(df, keep_bitmaps(df, **options), **names)
