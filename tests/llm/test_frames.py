import hashlib
import random

import zstandard
from odd_rows import docs, none  # noqa: F401
from pyspark.sql import functions as F

from quillbook.llm import frames


def brute(i, text):
    """Output, restored text and plan of a text by plain slicing."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows(spark):
    rng = random.Random(3)
    marks = ["<", "<P", "P>", "<S", "S>", "<M", "M>", "x", "é", "漢", "\U0001f600", "\n", " "]
    out = [(i, "".join(rng.choices(marks, k=rng.randint(0, 40)))) for i in range(1000, 1400)]
    out += [(i, "".join(rng.choices(["word ", "漢字", "\U0001f600", "é "], k=rng.randint(20_000, 60_000)))) for i in range(2000, 2012)]
    return out + [(1, "a<P>b"), (2, "<S>"), (3, None), (None, "no id"), (None, None), (4, "twice"), (4, "twice"), (2**62, "big")]


def check(made, source):
    wanted = sorted((brute(i, t) + (i,) for i, t in source), key=str)
    got = sorted(((r["n"], r["form"], None if r["form"] == "plain" else r["low"],
                   None if r["form"] == "plain" else r["high"] - r["low"], r["text"], r["doc_id"]) for r in made), key=str)
    assert got == wanted


def test_against_slicing(spark):
    source = rows(spark)
    outputs = frames.fill_in_middle(spark.createDataFrame(source, "doc_id long, text string").repartition(3))
    read = zstandard.ZstdDecompressor()
    found = []
    for r in outputs.collect():
        whole = b"".join(read.decompress(r["data"][a:b]) for a, b in zip([0, *r["ends"]], r["ends"])).decode()
        assert r["units"][-1:] == ([len(whole)] if whole else [])
        found.append({**r.asDict(), "text": whole})
    check(found, source)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    texts = {t for _, t in source}
    assert all(r["text"] in texts | {""} for r in frames.texts(frames.store(spark.createDataFrame(source, "doc_id long, text string"))).collect())


def test_digests_are_of_output_and_text(spark, docs):  # noqa: F811
    source = rows(spark) + [(r["doc_id"], r["text"]) for r in docs.collect()]
    frame = docs.unionByName(spark.createDataFrame(rows(spark), "doc_id long, text string"), allowMissingColumns=True)
    found = frames.digests(frames.fill_in_middle(frame)).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((str(r["doc_id"]), r["output_sha256"], r["restored_sha256"]) for r in found) == sorted(
        (str(i), sha(brute(i, t)[4]), sha(t)) for i, t in source)


def test_only_cut_frames_are_decompressed():
    out, opened = frames.Writer(), []
    text = "".join(chr(97 + i % 26) for i in range(10 * frames.FRAME))
    out.text(text.encode())
    stored = out.done()
    reader = frames.Reader(stored, lambda d: opened.append(len(d)) or zstandard.ZstdDecompressor().decompress(d))
    reader.copy(5, 9 * frames.FRAME + 7, out)
    part = out.done()
    assert len(stored.ends) == 10 and len(opened) == 2
    again = frames.Reader(part, zstandard.ZstdDecompressor().decompress)
    assert b"".join(map(again.raw, range(len(again)))).decode() == text[5 : 9 * frames.FRAME + 7]


def test_shares_and_empty_table(spark, none):  # noqa: F811
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    n = {r["form"]: r["count"] for r in frames.plans(frames.store(many)).groupBy("form").count().collect()}
    assert 300 < n["plain"] < 500 and 600 < n["spm"] < 840 and n["psm"] > 2600
    assert frames.digests(frames.fill_in_middle(none)).count() == 0
