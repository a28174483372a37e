"""A training corpus from the raw documents, stage by stage. Each stage is written and read again.

The first four stages return the columns of the documents, the last one the
pieces of the packed sequences. An empty table of documents gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbook.llm import decontam, langid, linededup, neardup, packing
from quillbook.session import stage_path


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language of the corpus; models learn from the documents that are not held out."""
    model = langid.train(langid.train_rows(docs.select("doc_id", "text", "lang")))
    return langid.drop_rejected(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of a line in ten documents or more only the first occurrence stays; documents left without text go."""
    kept = linededup.drop_repeated_lines(docs, min_docs=10, min_chars=1, keep="first")
    emptied = (F.col("_lines.n_dropped") > 0) & (F.btrim("text", F.lit(linededup.SPACE)) == "")
    return kept.where(~F.coalesce(emptied, F.lit(False))).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 or more."""
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.drop_leaks(docs, decontam.indexes(spark.read.parquet(f"{folder}/benchmark.parquet")))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of 1,024 ids, as pieces of documents; ``ids`` holds 4 bytes an id."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", known_language),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL can neither express the tokenizer nor the language models; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        out = stage_path(spark, name.replace(" ", "-"))
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
