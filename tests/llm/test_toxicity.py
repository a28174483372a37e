import numpy as np
import pyarrow as pa
import pytest

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import toxicity


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.initial(1).items()}
    inputs = np.concatenate([rng.standard_normal((9, 16)), np.zeros((1, 16))])
    seq = rng.integers(0, 9, (5, toxicity.WINDOW))
    seq[2, 30:], seq[4] = 9, 9
    label = np.array([1, 0, 1, 0, 1.0])
    loss = lambda: np.log1p(np.exp(-(2 * label - 1) * toxicity.forward(p, inputs, seq))).sum()
    logit, kept = toxicity.forward(p, inputs, seq, keep=True)
    found, on_inputs = toxicity.gradients(p, inputs, kept, 1 / (1 + np.exp(-logit)) - label)
    for name in ("w", "b", "u", "a", "v", "o", "c"):
        at, step = tuple(rng.integers(0, d) for d in p[name].shape), 3e-2
        old = p[name][at]
        p[name][at] = old + step
        high = loss()
        p[name][at] = old - step
        low = loss()
        p[name][at] = old
        assert (high - low) / (2 * step) == pytest.approx(found[name][at], rel=2e-2, abs=1e-4)
    assert on_inputs.shape == inputs.shape


def plain_logit(p, seq, inputs):
    """One window by a loop over its words, as the gates are written in books."""
    h, states = toxicity.HIDDEN, []
    sig = lambda x: 1 / (1 + np.exp(-x))
    real = [t for t in range(toxicity.WINDOW) if seq[t] < len(inputs) - 1]
    for d, order in ((0, range(toxicity.WINDOW)), (1, range(toxicity.WINDOW - 1, -1, -1))):
        state, found = np.zeros(h), {}
        for t in order:
            if t in real:
                x, r = inputs[seq[t]] @ p["w"][d] + p["b"][d], state @ p["u"][d]
                z, g = sig(x[:h] + r[:h]), sig(x[h : 2 * h] + r[h : 2 * h])
                new = np.tanh(x[2 * h :] + g * r[2 * h :])
                state = (1 - z) * new + z * state
            else:
                state = np.zeros(h)
            found[t] = state
        states.append(found)
    flat = np.array([np.concatenate([states[0][t], states[1][t]]) for t in range(toxicity.WINDOW)])
    score = np.tanh(flat @ p["a"]) @ p["v"]
    score = np.exp(np.array([score[t] if t in real else -30.0 for t in range(toxicity.WINDOW)]))
    return (score / score.sum()) @ flat @ p["o"] + p["c"][0]


def test_forward_against_a_loop():
    rng = np.random.default_rng(5)
    p = {k: v.astype(np.float64) for k, v in toxicity.initial(2).items()}
    inputs = np.concatenate([rng.standard_normal((30, 16)), np.zeros((1, 16))])
    seq = rng.integers(0, 30, (6, toxicity.WINDOW))
    for i, n in enumerate((64, 63, 10, 1, 0, 40)):
        seq[i, n:] = 30
    found = toxicity.forward(p, inputs, seq)
    assert found == pytest.approx([plain_logit(p, s, inputs) for s in seq], abs=1e-4)


def test_words_of_every_script():
    seen = lambda t: np.diff(toxicity.words(pa.array([t])).first)[0]
    assert seen("Привет мир дурак") == 3 and seen("größer als müßig") == 3 and seen("café naïve") == 2
    assert seen("你是白痴") == 3 and seen("مرحبا بالعالم") == 2 and seen("?! --") == 0
    one, two = (toxicity.words(pa.array([t])) for t in ("Привет мир", "Привет дом"))
    assert set(one.word) & set(two.word) and set(one.word) != set(two.word)


def test_toxic_words_of_other_scripts_are_learned():
    rng = np.random.default_rng(6)
    words = ["привет", "мир", "дом", "größe", "straße", "время", "человек", "день", "白天", "文字"]
    made, label = [], []
    for i in range(400):
        found = list(rng.choice(words, rng.integers(5, 120)))
        if i % 2:
            found[rng.integers(len(found))] = ["дурак", "白痴"][i // 2 % 2]
        made.append(" ".join(found))
        label.append(i % 2)
    label = np.array(label)
    fitted = toxicity.fit(made[:300], label[:300], 0.5, epochs=40)
    assert ((fitted.scores(pa.array(made[300:])) >= 0.7) == (label[300:] == 1)).mean() > 0.9


def test_a_late_passage_of_a_long_text_is_learned():
    """All windows of a training text count, not only some of them."""
    rng = np.random.default_rng(7)
    words = [a + b for a in "bdfgklmnprst" for b in ("an", "ore", "ist", "um")]
    made, label = [], []
    for i in range(160):
        found = list(rng.choice(words, 3000 if i % 4 < 2 else 100))
        if i % 2:
            found[-3 if i % 4 == 1 else 5] = "zorking"
        made.append(" ".join(found))
        label.append(i % 2)
    fitted = toxicity.fit(made, np.array(label), 0.5, epochs=60)
    right = (fitted.scores(pa.array(made)) >= 0.7) == (np.array(label) == 1)
    assert right[1::4].mean() > 0.9 and right.mean() > 0.9
    clean = [t.replace("zorking", words[0]) for t in made[1::4]]
    assert (fitted.scores(pa.array(clean)) < 0.7).mean() > 0.9


def test_windows_cover_every_word():
    first = np.array([0, 0, 1, 64, 65 + 64, 500])
    row, start, size = toxicity.windows(first)
    for r in range(5):
        seen = {w for s, n in zip(start[row == r], size[row == r], strict=True) for w in range(s, s + n)}
        assert seen == set(range(first[r], first[r + 1]))
        assert all(np.diff(start[row == r]) <= toxicity.STRIDE)


def texts(n, rng):
    words = [a + b for a in "bdfgklmnprst" for b in ("an", "ore", "ist", "um", "ela")]
    made, label = [], []
    for i in range(n):
        found = list(rng.choice(words, rng.integers(5, 200)))
        if i % 3 == 0:
            found[rng.integers(len(found))] = "zork" + rng.choice(["", "ed", "ing"])
        made.append(" ".join(found).capitalize() + ".")
        label.append(int(i % 3 == 0))
    return made, np.array(label)


@pytest.fixture(scope="module")
def model():
    made, label = texts(500, np.random.default_rng(1))
    return toxicity.fit(made, label, label.mean(), epochs=8)


def test_held_out_accuracy(model):
    made, label = texts(300, np.random.default_rng(2))
    found = model.scores(pa.array(made)) >= 0.7
    assert (found == (label == 1)).mean() > 0.95


def test_scores_do_not_depend_on_the_batch(model):
    made, _ = texts(20, np.random.default_rng(3))
    together = model.scores(pa.array(made))
    assert together == pytest.approx([model.scores(pa.array([t]))[0] for t in made], abs=1e-4)


def test_odd_rows_and_empty_tables(spark, docs, none, model):
    found = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score(none, model, ["doc_id"]).count() == 0
    labels = spark.createDataFrame([(3, 1), (None, 0), (6, None)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    assert {r["score"] for r in toxicity.score(docs, None, ["doc_id"]).collect()} == {0.5}


def test_training_takes_bounded_rows(spark, monkeypatch):
    made, label = texts(90, np.random.default_rng(4))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(x)) for i, x in enumerate(label)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda t, y, share: seen.update(n=len(t), share=share))
    toxicity.train(docs, labels, rows=20)
    assert seen["n"] == 40 and seen["share"] == pytest.approx(1 / 3)
