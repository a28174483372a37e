import itertools

import numpy as np
from pyspark.sql import functions as F

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import sharding


def test_the_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = sharding.curve_index(cells, bits)
        path = cells[np.argsort(place)]
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def dimensions():
    return {"bytes": F.octet_length(F.coalesce("text", F.lit(""))), "lang": sharding.as_number(F.col("lang")),
            "source": sharding.as_number(F.col("source"))}


def test_shards_differ_by_one_row_at_most(spark, docs):
    many = docs.crossJoin(spark.range(30).select("id")).drop("id")
    for frame, shards in ((docs, 8), (many, 7), (docs.limit(3), 8)):
        rows = sharding.hilbert_shards(frame, dimensions(), shards).collect()
        assert len(rows) == frame.count()
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(s, [])) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_equal_texts_are_cut_only_where_a_shard_ends(spark):
    rows = [(i, f"text {i % 20}", "en" if i % 3 else "de", f"src{i % 7}") for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    places = {}
    for r in sharding.hilbert_shards(frame, dimensions(), 8).collect():
        places.setdefault(r["doc_id"] % 20, set()).add(r["shard"])
    assert sum(len(v) - 1 for v in places.values()) <= 7


def test_files_hold_narrow_ranges(spark, tmp_path):
    rows = [(i, "x" * (i * 37 % 500), "en" if i % 2 else "de", f"src{i % 4}") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    placed = sharding.hilbert_shards(frame, dimensions(), 8)
    sharding.write_shards(frame, placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 2000
    combos = back.groupBy("shard").agg(F.count_distinct("lang", "source").alias("n")).collect()
    assert sum(r["n"] for r in combos) < 8 * 8


def test_files_hold_every_row_once(spark, docs, tmp_path):
    rows = [(1, "a b", "en", 1), (1, "a b", "de", 2), (1, "c d", "en", 3), (1, None, "fr", 4), (None, "a b", "en", 5),
            (None, "a b", "en", 6), (None, None, "en", 7), (2, "a b", "en", 8), (2, "a b", "en", 8)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string, n int").withColumn("lang", F.col("source"))
    for k, table in enumerate((frame, docs)):
        for limit in ("1", "5000000"):
            spark.conf.set("quillbook.group.rows", limit)
            path = str(tmp_path / f"shards{k}-{limit}")
            sharding.write_shards(table, sharding.hilbert_shards(table, dimensions(), 3), path)
            back = spark.read.parquet(path)
            assert sorted(map(str, back.select(*table.columns).collect())) == sorted(map(str, table.collect()))
            assert back.select("shard", "slot").distinct().count() == table.count()
    spark.conf.unset("quillbook.group.rows")


def test_empty_table(none):
    assert sharding.hilbert_shards(none, dimensions(), 8).count() == 0
