from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import langid

TEXTS = {"en": ["the cat and the hat", "that thing there", "and then the end"], "fr": ["le chat et la belle", "une été à paris", "elle est belle"]}


def model_of(texts):
    counts = {}
    for lang, found in texts.items():
        codes, starts = langid.letters(found)
        keys, starts = langid.trigrams(codes, starts)
        distinct, n = np.unique(np.delete(keys, starts), return_counts=True)
        counts[lang] = (distinct, n)
    return langid.estimate(counts)


def sequences(texts):
    for t in texts:
        words = "".join(c.lower() if c.isalpha() else " " for c in t).split()
        yield ["", ""] + list(" ".join([""] + words + [""]))[0:]


def brute(texts):
    """Interpolated Kneser-Ney by its textbook sums, over letters and one mark (a blank)."""
    tri = Counter()
    for t in texts:
        s = " " + "".join(c.lower() if c.isalpha() else " " for c in t)
        s = " ".join(s.split())
        s = "  " + s + (" " if not t[-1].isalpha() else "")
        tri.update(s[i - 2 : i + 1] for i in range(2, len(s)))
    before, heads = defaultdict(set), Counter()
    for g in tri:
        before[g[1:]].add(g[0])
    for pair in before:
        heads[pair[1]] += 1
    d = langid.DISCOUNT

    def p1(c):
        total = sum(heads.values())
        return max(heads[c] - d, 0) / total + max(d * len(heads) / total, 1e-9) / langid.CODES

    def p2(b, c):
        row = {p[1]: len(x) for p, x in before.items() if p[0] == b}
        total = sum(row.values())
        return p1(c) if not total else max(row.get(c, 0) - d, 0) / total + d * len(row) / total * p1(c)

    def p3(a, b, c):
        row = {g[2]: n for g, n in tri.items() if g[:2] == a + b}
        total = sum(row.values())
        return p2(b, c) if not total else max(row.get(c, 0) - d, 0) / total + d * len(row) / total * p2(b, c)

    return p3


def test_probabilities_are_the_textbooks():
    model = model_of(TEXTS)
    code = lambda c: 0 if c == " " else int(langid.letters([c])[0][1])
    for k, lang in enumerate(model.languages):
        p3 = brute(TEXTS[lang])
        for g in ("  t", "the", "th ", "elle"[:3], "zzz", " le", "t" + "q" + "e"):
            key = np.array([code(g[0]) << 16 | code(g[1]) << 8 | code(g[2])])
            assert model.bits(key)[0, k] == pytest.approx(-np.log2(p3(*g)), rel=1e-4), (lang, g)


def test_probabilities_sum_to_one():
    model = model_of(TEXTS)
    for context in (0x0014, 0x1408, 0x0000, 0xFFFF):
        total = (2.0 ** -model.bits(np.arange(langid.CODES) + (context << 8)).astype(float)).sum(axis=0)
        assert total == pytest.approx(np.ones(2), rel=1e-3)


def test_odd_rows_and_empty_tables(docs, none):
    model = langid.train(docs)
    found = {r["doc_id"]: r for r in langid.identify(docs, model, ["doc_id"]).collect()}
    assert {found[i]["lang_pred"] for i in (0, 1, 2, 9)} == {langid.UNKNOWN}
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[9]["score"] == 0
    assert found[3]["lang_pred"] == "en"
    assert langid.identify(none, model, ["doc_id"]).count() == 0
    assert langid.train(none) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None, ["doc_id"]).collect()} == {langid.UNKNOWN}
    assert langid.drop_rejected(none, model).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.train(langid.train_rows(docs))
    found = langid.identify(docs.withColumn("h", langid.held_out()), model, ["doc_id", "lang", "h"]).where("h and lang is not null")
    right, rejected, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")),
                                   F.sum(F.col("rejected").cast("int")), F.count("*")).first()
    assert right / n > 0.95 and rejected / n < 0.03


def test_texts_of_a_language_without_a_model_are_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('sf0.001', 'sf0.1')}/documents.parquet").where("lang is not null and length(text) between 100 and 20000")
    for unseen in ("en",):
        model = langid.train(langid.train_rows(docs.where(F.col("lang") != unseen)))
        found = langid.identify(docs.withColumn("h", langid.held_out()), model, ["lang", "h"])
        new = F.col("lang") == unseen
        gone, lost = found.agg(F.mean(F.when(new, F.col("rejected").cast("int"))),
                               F.mean(F.when(~new & F.col("h"), F.col("rejected").cast("int")))).first()
        assert gone > 0.9 and lost < 0.03, (unseen, gone, lost)


def test_limits_take_every_labelled_row_outside_its_model(spark):
    rows = [(f"{w} {v}", "en") for w in ("the cat", "that hat", "then end") for v in range(40)]
    rows += [("xq zj vk wq " * 8 + "abcdefgh"[i], "en") for i in range(8)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert (langid.train(frame.limit(1)).limits == np.inf).all()
    model = langid.train(frame)
    assert model.limits.shape == (1, langid.CLASSES) and (np.diff(model.limits[0]) <= 0).all()
