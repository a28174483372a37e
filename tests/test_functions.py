import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
import xxhash
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillbook.functions import codes, groups, identity, rules


def one(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_source_prefix_and_ledger_suffix(spark):
    found = one(spark, "c string", [("0451",), ("04",), ("0 4x",), (None,), ("",)], codes.source_prefix("c"))
    assert found == ["045", None, None, None, None]
    found = one(spark, "c string", [("0102",), ("010",), ("01 2",), ("01022",), (None,)], codes.ledger_suffix("c"))
    assert found == ["02", None, None, "02", None]


def test_data_type_and_indicator(spark):
    assert one(spark, "c string", [("9100",), ("9900",), ("1",), (None,)], codes.data_type("c")) == [
        "Statistical", "Financial", "Financial", "Financial"]
    assert one(spark, "c string", [("10",), ("CR",), ("63",), ("99",)], codes.debit_credit("c")) == [
        "Debit", "Credit", "Credit", None]


@pytest.mark.parametrize("text, day", [
    ("2025001", date(2025, 1, 1)), ("2024366", date(2024, 12, 31)), ("2025366", None), ("2025399", None),
    ("2025000", None), ("0000001", None), ("25001", None), ("20250011", None), ("abc", None), ("", None), (None, None),
    ("1900366", None), ("2000366", date(2000, 12, 31)),
])
def test_julian_date(spark, text, day):
    assert one(spark, "c string", [(text,)], codes.julian_date("c")) == [day]


def test_julian_checks(spark):
    rows = [("2025001",), ("0",), ("",), (None,), ("2025399",), ("0000000",)]
    assert one(spark, "c string", rows, codes.is_julian("c")) == [True, False, False, False, False, False]
    assert one(spark, "c string", rows, codes.is_julian("c", optional=True)) == [True, True, True, True, False, True]
    assert one(spark, "c string", [("2025-01-31",), ("x",), (None,)], codes.is_date("c", "yyyy-MM-dd")) == [True, False, False]


@pytest.mark.parametrize("policy, wanted", [
    ("ignore_negative", ["12.34", "0.00", "0.00", "0.00"]),
    ("get_precision", ["12.34", "-0.50", "0.00", "0.00"]),
    ("ignore_precision", ["1234.00", "-50.00", "0.00", "0.00"]),
    ("decimal_precision", ["1234.00", "-50.00", "0.00", "0.00"]),
    ("absolute_precision", ["1234.00", "50.00", "0.00", "0.00"]),
])
def test_amount_policies(spark, policy, wanted):
    rows = [("1234",), ("-50",), ("N/A",), (None,)]
    assert one(spark, "c string", rows, codes.amount("c", policy)) == [Decimal(w) for w in wanted]


def test_unknown_policy():
    with pytest.raises(ValueError):
        codes.amount("c", "other")


def test_year_positions(spark):
    for text, pattern in (("2025001", "yyyyDDD"), ("12/31/2025", "MM/dd/yyyy"), ("251231", "yyMMdd")):
        assert one(spark, "c string", [(text,)], codes.year_of("c", pattern)) == [2025]


def test_ascii_only(spark):
    assert one(spark, "c string", [("Café ✓ x",), ("",)], codes.ascii_only("c")) == ["Caf  x", ""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=1, max_size=20).filter(lambda t: "\x00" not in t and t.isprintable()), min_size=1, max_size=8))
def test_uuids_agree_with_the_standard_library(spark, names):
    class Empty:
        bytes = b""

    df = spark.createDataFrame([(n,) for n in names], "c string")
    for name, u3, u5 in df.select("c", identity.uuid3("c"), identity.uuid5("c")).collect():
        assert u3 == str(uuid.uuid3(Empty, name))
        assert u5 == str(uuid.uuid5(uuid.NAMESPACE_X500, name))


def test_uuid_of_blank(spark):
    assert one(spark, "c string", [("",), (None,)], identity.uuid3("c")) == ["", None]


def test_row_hash_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(identity.row_hash(["x", "y", "z"])).distinct().count() == 2


def test_accounting_id(spark):
    df = spark.range(200).withColumn("text", F.col("id").cast("string"))
    ids = [r[0] for r in df.select(identity.accounting_id(["id", "text"], datetime(2025, 12, 8), True)).collect()]
    assert len(set(ids)) == 200
    assert all(i.startswith("202512081") and len(i) == 30 and i[9] in "01" for i in ids)
    assert {i[9] for i in ids} == {"0", "1"}


def test_mask_round_trip(spark):
    key = F.lit("0123456789abcdef")
    df = spark.createDataFrame([("secret",), ("",), (None,)], "c string").withColumn("m", identity.mask("c", key))
    assert values(df, identity.unmask("m", key)) == [(None,), (None,), ("secret",)]


@pytest.fixture
def small_groups(spark):
    spark.conf.set(groups.GROUP_ROWS, "50")
    yield
    spark.conf.unset(groups.GROUP_ROWS)


def skewed(spark):
    """A null key and one key with a third of all rows each, and exact copies."""
    df = spark.range(600).select((F.col("id") % 3).alias("m"), (F.col("id") * 7 % 40).alias("o"), (F.col("id") % 11).alias("v"))
    key = F.when(F.col("m") == 0, None).when(F.col("m") == 1, 1).otherwise(F.col("o") + 2)
    return df.select(key.alias("k"), "o", "v")


def test_large_groups_are_found(spark, small_groups):
    assert groups.find_large(skewed(spark), ["k"]).ids.count() == 2
    assert groups.find_large(skewed(spark), ["k"], within=[spark.range(10)]) == groups.Large()


def test_numbering_of_large_groups(spark, small_groups):
    df = skewed(spark)
    found = groups.number_rows(df, ["k"], ["o", "v"], "n")
    wanted = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o", "v")).cast("bigint"))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("some", [False, True])
def test_neighbours_in_large_groups(spark, small_groups, following, some):
    df = skewed(spark).withColumn("u", F.monotonically_increasing_id()).withColumn("v", F.when(F.col("v") > 2, F.col("v")))
    among = F.col("u") % 5 == 0 if some else None
    found = groups.neighbour(df, ["k"], ["o", "u"], "n", F.col("v"), following, among)
    wanted = groups.neighbour(df, ["k"], ["o", "u"], "n", F.col("v"), following, among, large=groups.Large())
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    if not some:
        window = Window.partitionBy("k").orderBy("o", "u")
        plain = df.withColumn("n", (F.lead("v") if following else F.lag("v")).over(window))
        assert found.exceptAll(plain).isEmpty()


LINE = ("gl_full_source_code string, orig_gl_account string, orig_gl_description_1 string, orig_gl_description_2 string, "
        "orig_gl_description_3 string, orig_gl_source_document_id string, orig_gl_project_code string, orig_gl_center string")


@pytest.mark.parametrize("code, account, attribute, wanted", [
    ("545X", "1", "contractnumber", "0123456789"),
    ("545X", "1", "activitysourceoriginatinguserid", "abcde"),
    ("041", "2861600", "contractnumber", "0123456789abcdefghij 0123 DTCCK"),
    ("043", "2871100", "contractnumber", None),
    ("043", "2898000", "contractnumber", "TA second"),
    ("143", "1900000", "contractnumber", None),
    ("143", "1200000", "contractnumber", "TA second"),
    ("143", "1900000", "groupcontractnumber", "D0000000012345"),
    ("146", "4111999", "activitydepositsourcebatchidentifier", "00012345"),
    ("069", "1", "contractnumber", "TA second"),
    ("039", "1", "sourceagentidentifier", "TA second"),
    ("077", "1", "sourceagentidentifier", "third"),
    ("017", "1", "checknumber", None),
    ("903", "1", "contractsourcesystemname", "External A"),
    ("444", "1", "sourcesystemreinsurancecounterpartycode", "C001"),
    ("A4V", "VOID1", "contractnumber", "56789abcde"),
    ("999", "1", "contractnumber", None),
])
def test_attribute_rules(spark, code, account, attribute, wanted):
    row = (code, account, "0123456789abcdefghij 0123 DTCCK", "TA second", "third", "D0000000012345", "PRJ", "C001")
    df = spark.createDataFrame([row], LINE)
    assert df.select(rules.derived_attributes()[attribute]).first()[0] == wanted


def test_pattern_hashes(spark):
    """The code of a line counts under one pattern, that of the header under another, none under a third."""
    patterns = {"own": identity.HashPattern(("A",)), "none": identity.HashPattern(("B",), "none"), "header": identity.HashPattern(("C",), "header")}
    rows = spark.createDataFrame(
        [(s, h, code, line) for s in "ABC" for h in ("x", None) for code in ("1", None) for line in ("l",)],
        "system string, h string, code string, line string")

    def hashed(df):
        return identity.pattern_hashes(df, "system", patterns, ["h", "audit"], ["line", "code"], "code", "h", ignored=["audit"])

    found = hashed(rows)
    by_hand = {"A": ["line", "code"], "B": ["line"], "C": ["line", "h"]}
    for system, columns in by_hand.items():
        own = found.where(F.col("system") == system)
        assert own.where(F.col("line_hash") != identity.row_hash(columns)).isEmpty()
        assert own.where(F.col("header_hash") != identity.row_hash(["h"])).isEmpty()
    assert found.select("system", "line_hash").distinct().groupBy("system").count().orderBy("system").collect() == [("A", 2), ("B", 1), ("C", 2)]
    assert hashed(rows.limit(0)).isEmpty()
    with pytest.raises(Exception, match="no pattern for source system D"):
        hashed(rows.withColumn("system", F.lit("D"))).collect()


def test_a_system_has_one_pattern():
    patterns = {"one": identity.HashPattern(("A", "B")), "two": identity.HashPattern(("B",), "none")}
    assert identity.pattern_of(patterns, "A") == "one"
    with pytest.raises(ValueError, match="one, two"):
        identity.pattern_of(patterns, "B")
    with pytest.raises(ValueError, match="no pattern"):
        identity.pattern_of(patterns, "C")


def test_accounting_ids_digit_by_digit(spark):
    """Against the hash of a library, over nulls, separators and backslashes."""
    rows = [(i, t) for i, t in enumerate(["x", None, "", "a|b", "c\\d", "é" * 40, "0"])]
    found = spark.createDataFrame(rows, "id int, text string").select(
        "id", identity.accounting_id(["id", "text"], datetime(2025, 12, 8), False).alias("number"))

    def by_hand(i, text):
        text = (text or "").replace("\\", "\\\\").replace("|", "\\|")
        value = xxhash.xxh64(f"1|{i}|{text}".encode(), seed=42).intdigest()
        value -= (value >> 63) << 64
        return f"202512080{'0' if value < 0 else '1'}{abs(value):020d}"

    assert dict(found.collect()) == {i: by_hand(i, t) for i, t in rows}
