import random
import re

import numpy as np
import pyarrow as pa

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import neardup
from quillbook.llm.batches import hashes, spans, utf8


def shingles(text, size):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(rng, words, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


WORDS = [f"w{i}" for i in range(400)]


def corpus():
    """Groups of copies of many degrees, a passage in many texts, and unrelated texts."""
    rng = random.Random(5)
    rows, passage = [], rng.choices(WORDS, k=40)
    for base in range(12):
        words = rng.choices(WORDS, k=rng.choice([6, 30, 120]))
        rows += [" ".join(words)] * rng.randint(1, 4)
        rows += [" ".join(edited(rng, words, rng.choice([0, 0.02, 0.05, 0.08, 0.1, 0.2]))) for _ in range(15)]
    rows += [" ".join(rng.choices(WORDS, k=20) + passage + rng.choices(WORDS, k=20)) for _ in range(60)]
    rows += ["A b", "a  B", "a", "a", "b", "", " \n", None, "a a a", "a a"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_are_those_of_all_pairs(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int")
    for size in (2, 5):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(frame, size=size).collect()}
        assert found == brute(rows, size)


def test_the_last_step_finds_what_hubs_leave(spark, monkeypatch):
    """Without rounds of hubs all pairs come from the last step, by sets and by bits."""
    rows = corpus()[:150]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "HUB_ROUNDS", 0)
    for exact in (neardup.EXACT, 20):
        monkeypatch.setattr(neardup, "EXACT", exact)
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(frame, size=2).collect()}
        assert found == brute(rows, 2)


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in neardup.drop_near_duplicates(frame, size=2).collect()}
    assert kept == {i for i, (_, c) in brute(rows, 2).items() if c == i}


def test_one_large_group_of_copies(spark):
    rng = random.Random(9)
    base = rng.choices(WORDS, k=80)
    rows = list(enumerate(" ".join(edited(rng, base, 0.03)) for _ in range(400)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: c for i, (_, c) in brute(rows, 2).items()}


def test_odd_rows_and_empty_tables(docs, none):
    found = neardup.near_duplicates(docs, size=2).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by_id[0]["n_shingles"] == 0 and by_id[1]["component_id"] == 1 and by_id[2]["kept"]
    assert by_id[4]["component_id"] == by_id[5]["component_id"] == 3
    assert all(r["kept"] and r["component_id"] is None for r in found if r["doc_id"] is None)
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.drop_near_duplicates(none).count() == 0


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    copy, other, third = "one two three four five six", "a text of its own in here", "the very last text of all"
    rows = [(1, copy, "x"), (5, copy, "x"), (5, other, "x"), (6, other, "y"), (7, third, "x"), (7, third, "x"), (7, third, "y"),
            (8, third, "x"), (None, copy, "x"), (None, None, "x"), (9, "", "x"), (9, "", "x"), (2, copy.upper(), "z"), (1, copy.upper(), "z")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, node string")
    kept = neardup.drop_near_duplicates(frame).collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in kept) == sorted(
        [("1", copy), ("5", other), ("7", third), ("None", copy), ("None", ""), ("9", ""), ("9", "")])


def test_tables_of_one_short_text(spark):
    for n in range(1, 6):
        assert [len(neardup._shingles(pa.record_batch([pa.array(["a b c d e"[: 2 * n - 1]])], ["text"]), size)[0])
                for size in (2, 5)] == [max(n - 1, 1), 1]
    frame = spark.createDataFrame([(7, "two words")], "doc_id long, text string")
    assert [tuple(r) for r in neardup.near_duplicates(frame, size=5).collect()] == [(7, 1, 7, True)]


def test_a_word_hashes_alike_wherever_it_stands():
    value = []
    for text in ("word", "other text and word", "word " * 3):
        data, offsets = utf8(pa.array(["before", text]))
        starts, ends, row = spans(data != 32, offsets)
        value.append(hashes(data, starts, ends)[-1])
    assert len(set(value)) == 1


def test_spans_end_with_their_row():
    data, offsets = utf8(pa.array(["ab", "cd", None, "", "e f"]))
    starts, ends, row = spans(data != 32, offsets)
    assert list(zip(starts, ends, row, strict=True)) == [(0, 2, 0), (2, 4, 1), (4, 5, 4), (6, 7, 4)]


def test_agreement_of_signatures_estimates_similarity():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    sig = neardup._signatures(np.concatenate([values[:900], values[100:]]), np.array([0, 900, 1800]))
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.15


def test_minima_estimate_similarity_closely():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    both = np.concatenate([np.sort(values[:900]), np.sort(values[100:])])
    same, bits = [], []
    for c, (a, b) in enumerate(neardup._minima(both, np.array([0, 900]), range(neardup.FINE, neardup.FINE + neardup.BITS))):
        same.append(a == b)
        bits.append((a >> np.uint32(c % 8) & 1) != (b >> np.uint32(c % 8) & 1))
    assert abs(np.mean(same) - 0.8) < 0.03 and abs(np.sum(bits) - 0.1 * neardup.BITS) < 80


def test_agreement_counts_equal_bytes(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (50, neardup.FINE), dtype=np.uint8)
    b = np.where(rng.random(a.shape) < 0.6, a, rng.integers(0, 256, a.shape, dtype=np.uint8)).astype(np.uint8)
    rows = [(x.view(np.int64).tolist(), y.view(np.int64).tolist(), int((x == y).sum())) for x, y in zip(a, b, strict=True)]
    frame = spark.createDataFrame(rows, "x array<long>, y array<long>, n int")
    assert all(r["n"] == r["m"] for r in frame.withColumn("m", neardup._agreement("x", "y")).collect())
