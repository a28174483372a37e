"""Texts of a row as one: lossless, sorted as the columns are, and used where lines are shuffled."""

import glob
import random

import pytest
from conftest import FOLDER, values
from pyspark.sql import functions as F

from quillbook.functions import codes, compact
from quillbook.operators import classify
from quillbook.plans import load, workload
from quillbook.session import materialise

TEXTS = [None, "", "\x00", "\x01", "\x02", "\x02A", "\x02C", "\x00C", "a", "a\x00b", "a\x01", "ab", "\x03", "é", "\U0010ffff", "|", " "]


@pytest.fixture
def odd(spark):
    pick = random.Random(3)
    return spark.createDataFrame(
        [(i, *[pick.choice(TEXTS) for _ in range(3)]) for i in range(1500)], "i int, a string, b string, c string")


def test_every_text_comes_back(odd):
    names = compact.text_columns(odd, ["b"])
    assert names == ["b", "a", "c"]
    back = compact.unpack(compact.pack(odd, names), names)
    assert values(back, "i", "a", "b", "c") == values(odd)


def test_bytes_that_are_no_text_come_back(spark):
    rows = spark.range(1).select(F.expr("cast(unhex('ff61') as string)").alias("a"), F.lit("x").alias("b"))
    assert compact.unpack(compact.pack(rows, ["a", "b"]), ["a", "b"]).selectExpr("hex(a)", "b").first()[:] == ("FF61", "x")


def test_packed_rows_sort_as_their_columns(odd):
    packed = compact.pack(odd, ["b", "a", "c"])
    by_columns = packed.join(odd, "i").orderBy("b", "a", "c").select(compact.PACKED).collect()
    assert packed.select(compact.PACKED).orderBy(compact.PACKED).collect() == by_columns


def line_parts(spark):
    raw, known = workload.extracts(spark, FOLDER), load.Lookups(**workload.lookups(spark, FOLDER))
    return raw, known, workload.loaded_headers(spark, FOLDER)


def test_lines_are_shuffled_as_one_text(spark):
    """The exchange on the header's key carries few columns: what a line says is in one of them."""
    with workload.inputs():
        raw, known, headers = line_parts(spark)
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
        try:
            rows = load.classified_lines(raw, known, headers, workload.LINE_BATCH)
            plan = rows._jdf.queryExecution().executedPlan()
            todo, widths = [plan], []
            while todo:
                node = todo.pop()
                if node.nodeName() == "AdaptiveSparkPlan":
                    todo.append(node.initialPlan())
                if node.nodeName() == "Exchange" and "_header_key" in node.simpleString(100):
                    names = [a.name() for a in (node.output().apply(i) for i in range(node.output().size()))]
                    widths.append(names)
                todo += [node.children().apply(i) for i in range(node.children().size())]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = next(names for names in widths if compact.PACKED in names)
    assert not {"orig_gl_description_1", "default_amount", "gl_source_code", "hard_error_message"} & set(lines)


def test_many_lines_take_more_tasks(spark, monkeypatch):
    """Tasks by lines, not by the session's partitions, and the same rows."""
    with workload.inputs():
        raw, known, headers = line_parts(spark)
        wanted = values(load.classified_lines(raw, known, headers, workload.LINE_BATCH), "orig_gl_source_document_id", "error_cleared", "line_number")
        monkeypatch.setattr(classify, "TASK_LINES", 500)
        dealt = load.classified_lines(raw, known, headers, workload.LINE_BATCH)
        assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
        assert values(dealt, "orig_gl_source_document_id", "error_cleared", "line_number") == wanted


def test_no_header_has_more_lines_than_the_bound(spark):
    """Also where lookups multiply lines."""
    with workload.inputs():
        raw, known, headers = line_parts(spark)
        maps = known.in_force(workload.LINE_BATCH)
        rows = load._all_lines(raw, workload.LINE_BATCH, None)
        twice = (maps[0].unionByName(maps[0]), *maps[1:])
        for lookups in (maps, twice):
            keyed = classify._with_key(classify.prepare_lines(rows, *lookups), F.col("random_counter"))
            assert keyed.groupBy(classify.KEY).count().agg(F.max("count")).first()[0] <= classify.most_lines(rows, *lookups)


def test_stages_are_compressed_well(spark):
    path = materialise(spark.range(10), "small").stage_path
    assert glob.glob(f"{path.removeprefix('file:')}/*.zstd.parquet")


def test_numbers_of_text(spark):
    rows = spark.createDataFrame([(t,) for t in (" 12 ", "-3", "+4", "", " ", None, "N/A", "1.5", "12x", "99999999999")], "t string")
    assert rows.select(codes.number("t", "int").eqNullSafe(F.col("t").try_cast("int"))).distinct().collect() == [(True,)]
