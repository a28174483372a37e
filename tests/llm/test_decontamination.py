import random

import numpy as np
import pyarrow as pa

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import decontam

WORDS = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "en", "or", "ist", "um")] + ["the", "of", "and"] * 10


def items(n=60):
    rng = random.Random(2)
    return [(i, " ".join(rng.choices(WORDS, k=rng.randint(10, 40))).capitalize() + "? " + " ".join(rng.choices(WORDS, k=6)) + ".") for i in range(n)]


def test_wand_finds_all_items_above_the_threshold():
    rng = random.Random(4)
    for threshold in (0.3, 0.6, 0.9):
        index = decontam.Index(items(), threshold)
        for _ in range(150):
            terms = sorted(set(rng.choices(range(len(index.vocabulary)), k=rng.randint(1, 60))))
            score = np.zeros(len(index.ids))
            for t in terms:
                score[index.lists[t].items] += index.lists[t].weights
            wanted = {i for i, s in enumerate(score) if s >= threshold}
            found = dict(index.retrieve(terms))
            assert set(found) == wanted and all(abs(found[i] - score[i]) < 1e-9 for i in found)


def brute(index, text):
    """All passages against all items, one at a time."""
    w, _ = decontam.words(pa.array([text], pa.string()))
    found = set()
    for start in range(0, max(len(w), 1), index.longest):
        passage = w[start : start + 2 * index.longest]
        own = set(passage.tolist())
        for i in range(len(index.ids)):
            score = sum(p.weights[p.items.index(i)] for t, p in zip(index.vocabulary.tolist(), index.lists, strict=True) if t in own and i in p.items)
            held = decontam.runs(passage)
            if (score >= index.threshold and np.isin(index.question[i], held).mean() >= decontam.QUESTION
                    and np.isin(index.answer[i], held).mean() >= decontam.ANSWER):
                found.add(index.ids[i])
    return found


def texts():
    rng = random.Random(8)
    out = ["", None, "short"]
    for k in range(40):
        words = rng.choices(WORDS, k=rng.choice([5, 60, 300]))
        item = items()[k][1]
        if k % 3 == 0:  # whole
            words[len(words) // 2 : len(words) // 2] = [item.upper()]
        elif k % 3 == 1:  # without its answer
            words += [item.rsplit("? ", 1)[0]]
        out.append(" ".join(words))
    return out


def test_leaks_are_those_of_all_passages_and_items(spark):
    index = decontam.Index(items())
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(frame, [index]).collect()}
    assert found == {(i, k) for i, t in rows for k in brute(index, t)}
    assert {(3 + k, k) for k in range(0, 40, 3)} <= found
    assert not any(i == 3 + k for k in range(1, 40, 3) for i, item in found if item == k)
    clean = {r["doc_id"] for r in decontam.drop_leaks(frame, [index]).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in found}


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    frame = spark.createDataFrame(items(), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    one = {tuple(r)[:2] for r in decontam.leaks(docs, decontam.indexes(frame)).collect()}
    monkeypatch.setattr(decontam, "INDEX_BYTES", 2000)
    several = decontam.indexes(frame)
    assert len(several) > 3
    clean = decontam.drop_leaks(docs, several).count()
    assert len(one) >= 13 and clean <= docs.count() - 13


def test_blocks_do_not_change_what_is_found(spark, monkeypatch):
    rng = random.Random(3)
    rare = items() + [(100 + i, " ".join(rng.choices(WORDS[:12], k=rng.choice([2, 5, 12, 70])))) for i in range(60)]
    rows = list(enumerate(texts()))
    for _, item in rare:  # items of which about the threshold is left
        w = item.split()
        for share in (0.5, 0.6, 0.7, 0.8):
            kept = w[int(len(w) * (1 - share)):]
            rows.append((len(rows), " ".join(rng.choices(WORDS, k=30) + kept + rng.choices(WORDS, k=30))))
    frame = spark.createDataFrame(rare, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = decontam.indexes(frame)
    assert len(one) == 1
    wanted = sorted(map(tuple, decontam.leaks(docs, one).collect()))
    monkeypatch.setattr(decontam, "INDEX_BYTES", 2000)
    several = decontam.indexes(frame)
    assert len(several) > 3
    found = sorted(map(tuple, decontam.leaks(docs, several).collect()))
    assert len(wanted) > 50 and [f[:2] for f in found] == [f[:2] for f in wanted]
    assert np.allclose([f[2:] for f in found], [f[2:] for f in wanted])
    assert {r["doc_id"] for r in decontam.drop_leaks(docs, several).collect()} == {i for i, _ in rows} - {f[0] for f in wanted}


def test_short_and_unspaced_items_are_found(spark):
    chinese, thai = "光合作用在植物的哪个部分进行？答案是叶绿体。", "พืชสังเคราะห์แสงในส่วนใดของเซลล์คลอโรพลาสต์"
    found = [(1, "Who wrote Hamlet? Shakespeare."), (2, "Paris France"), (3, chinese), (4, thai), (5, "水"), (6, "What is two plus two? Four."),
             (7, "q7" * 300), (8, "..."), (9, "Paris France")]
    rows = [(10, "so, who WROTE Hamlet? Shakespeare! and more"), (11, "in paris, France it is"), (12, "前面的文字" + chinese + "后面的文字"),
            (13, "ก" + thai + "ข"), (14, "喝 水"), (15, "what is two plus two? four"), (16, "x9" + "q7" * 300 + "y"),
            (20, "France Paris"), (21, "光合作用很重要，叶绿体也很重要，植物在进行"), (22, "who wrote it, Shakespeare or Hamlet"), (23, "paris"), (24, "france")]
    index = decontam.indexes(spark.createDataFrame(found, "item_id long, text string"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, index).collect()}
    assert pairs == {(10, 1), (11, 2), (11, 9), (12, 3), (13, 4), (14, 5), (15, 6), (16, 7)}
    assert {r["doc_id"] for r in decontam.drop_leaks(docs, index).collect()} == {20, 21, 22, 23, 24}


def test_words_of_scripts_without_blanks_are_pairs_of_characters():
    w, first = decontam.words(pa.array(["ab 水火土", "水火", None, "火", "Ab。水", "naïve—café"]))
    assert first.tolist() == [0, 3, 4, 4, 5, 7, 9]
    assert w[1] == w[3] and w[0] == w[5] and len(set(w.tolist())) == 7


def test_odd_rows_and_empty_tables(spark, docs, none):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "few words"), (None, "one two three four five six seven eight nine ten")],
                                  "item_id long, text string")
    index = decontam.indexes(frame)
    found = decontam.leaks(docs, index).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(6, None), (7, None)}
    assert decontam.leaks(none, index).count() == 0 and decontam.leaks(docs, decontam.indexes(frame.limit(0))).count() == 0
    assert decontam.drop_leaks(docs, index).columns == docs.columns
