import hashlib
import random
import re

import xxhash
from conftest import FOLDER
from pyspark.sql import functions as F

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import winnow
from quillbook.llm.queries import QUERIES


def h(*parts):
    seed = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def pieces(text):
    """Words, and of longer runs and short texts every code point with its successor."""
    out, short = [], len(text or "") <= winnow.SHORT
    for run in re.findall(r"[^ \t\n\x0b\f\r]+", text or ""):
        out += [run] if len(run) <= winnow.WORD and not short else [run[i : i + 2] for i in range(len(run))]
    return out


def brute(text, k=winnow.K, w=winnow.W):
    found = [h(p) for p in pieces(text)]
    if not found:
        return []
    grams = [h(*found)] if len(found) < k else [h(*found[i : i + k]) for i in range(len(found) - k + 1)]
    values = [(g & (1 << 64) - 1) >> 33 for g in grams]
    chosen = []
    for start in range(max(1, len(values) - w + 1)):
        window = list(enumerate(values))[start : start + w]
        best = min(window, key=lambda x: (x[1], -x[0]))
        if best not in chosen:
            chosen.append(best)
    return chosen


def test_against_brute_force(docs):
    for k, w in ((2, 3), (3, 4), (5, 16), (3, 1)):
        found = winnow.fingerprints(docs.where("text is null or length(text) < 6000"), "text", "fp", k, w).collect()
        for r in found:
            assert [(x["pos"], x["hash"]) for x in r["fp"]] == brute(r["text"], k, w), (r["text"], k, w)


def alike(a, b):
    a, b = ({x for _, x in f} for f in (a, b))
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_query_against_brute_force(spark):
    """Edited text, fingerprints and both likenesses of every document."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in rows), reverse=True)
    found = {r["doc_id"]: r for r in QUERIES["op9_winnowing"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    show = lambda fp: " ".join(f"{x:x}" for x in dict.fromkeys(x for _, x in fp))
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        tail = len(text) // 3
        edited = text[: len(text) - tail] + following[:tail]
        own, other = brute(text), brute(edited)
        r = found[i]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (show(own), show(other))
        assert abs(r["near_edited"] - alike(own, other)) < 1e-9 and abs(r["near_next"] - alike(own, brute(following))) < 1e-9
    assert sum(r["near_edited"] > r["near_next"] for r in found.values()) >= 0.99 * len(found)


def test_short_and_shifted_texts_share_hashes(spark):
    rng = random.Random(1)
    chinese = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(500))
    vocabulary = ["".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(3, 8))) for _ in range(500)]
    rows = [(-1, chinese, "的" + chinese, "")]
    for n in range(10, 21):
        words, other = rng.choices(vocabulary, k=n), rng.choices(vocabulary, k=n)
        rows.append((n, " ".join(words), " ".join(words[: -(n // 3)] + other[-(n // 3) :]), " ".join(other)))
    frame = spark.createDataFrame(rows, "n int, a string, b string, c string")
    for c in "abc":
        frame = winnow.fingerprints(frame, c, f"f{c}").withColumn(f"f{c}", winnow.hashes(F.col(f"f{c}")))
    found = frame.select("n", F.size("fa").alias("hashes"), winnow.likeness(F.col("fa"), F.col("fb")).alias("edited"),
                         winnow.likeness(F.col("fa"), F.col("fc")).alias("other")).collect()
    for r in found:
        assert r["hashes"] >= 5 and r["other"] < 0.15 and (r["edited"] > 0.9 if r["n"] < 0 else 0.2 < r["edited"] < 0.95), r


def test_likeness(spark):
    a, b = F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3))
    none = F.array().cast("array<int>")
    row = spark.range(1).select(winnow.likeness(a, b), winnow.likeness(a, none), winnow.likeness(none, none)).first()
    assert list(row) == [1 / 3, 0.0, 1.0]


def test_next_rows(spark):
    for ids in ([5], [1, 2, 3, 9, 1000, 1001, 5000], [7, 7, 3, None, None, 2], list(range(0, 300, 3)), [None], [10**15, 4, -10**15, 12], [2**63 - 1, 0, -2**63]):
        frame = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
        dealt, run = winnow.in_runs(frame, "doc_id", F.xxhash64("text"))
        got = dealt.withColumn("next", F.lead("doc_id").over(run)).where("_guest = 0").collect()
        order = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        wanted = list(zip(order, order[1:] + order[:1], strict=True))
        assert sorted(((r["doc_id"], r["next"]) for r in got), key=str) == sorted(wanted, key=str)


def test_empty_table(none):
    dealt, run = winnow.in_runs(none, "doc_id", F.lit(0).cast("long"))
    assert winnow.fingerprints(dealt, "text", "fp").count() == 0
