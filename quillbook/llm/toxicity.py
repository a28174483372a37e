"""Toxicity of texts by a bidirectional gated recurrent network with attention.

Words are runs of letters and digits of any script; where a script has no blanks
between words, any two characters in a row are one. A word is read as an embedding of the word itself and one of its characters:
the embeddings of the runs of three and of five bytes around each of its bytes
(both tables are addressed by hash, so their size is fixed, and unknown or
inflected words still have their runs). A window of WINDOW words
runs through a gated recurrent unit in both directions; attention pools the
states, and a linear layer gives the window's logit. Every text is scored in
all its windows, each overlapping the next by half, and the highest one
decides: a long text is toxic where one of its parts is.

The network is trained in numpy on the driver on at most ``rows`` texts of
either label: labels are of texts, so in every epoch the window that scores
highest stands for its text, besides random windows of clean texts. The logit
is then mapped to a probability by logistic regression, weighted by how often
either label occurs among all labelled rows.

A text without words (null, empty, punctuation) is one empty window. Rows
are scored one by one, so copies, ties and skew do not matter. Without labelled
rows of both kinds every text scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbook.llm.batches import MIX1, chunks, hashes, lowered, mixed, utf8
from quillbook.llm.decontam import word_spans

WINDOW, STRIDE = 64, 32
WORDS, GRAMS = 1 << 15, 1 << 15
EMBEDDED, HIDDEN, POOLED = 8, 8, 8
#: Texts of either label that are learned from, with all their windows.
ROWS = 2500
EPOCHS, BATCH, RATE = 10, 128, 0.01
SCORED = 2048

Parameters = dict[str, np.ndarray]


@dataclass
class Words:
    """The words of some rows: distinct ones with their table entries, and for each row where its words are."""

    index: np.ndarray
    first: np.ndarray
    word: np.ndarray
    gram: np.ndarray
    gram_first: np.ndarray


def words(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    data = lowered(data)
    starts, ends, row = word_spans(data, offsets)
    value, at, index = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[at], ends[at]
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.repeat(starts - first, size) + np.arange(size.sum())
    # Runs of bytes around each byte; 0 stands before and after a word.
    own = data[place].astype(np.uint64)
    inside = np.arange(len(place)) - np.repeat(first, size)
    left = np.repeat(size, size) - 1 - inside
    run = own.copy()
    grams = np.empty((len(own), 2), np.int64)
    for k in (1, 2):
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[k:], after[:-k] = own[:-k], own[k:]
        run = ((np.where(inside >= k, before, 0) << np.uint64(8)) | np.where(left >= k, after, 0)) | (run << np.uint64(16))
        grams[:, k - 1] = mixed(run + np.full(1, k, np.uint64) * MIX1) % np.uint64(GRAMS)
    return Words(index, np.searchsorted(row, np.arange(len(offsets))), (value % np.uint64(WORDS)).astype(np.int64),
                 grams.ravel(), 2 * first)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of all windows. The last one of a row ends with it."""
    n = np.diff(first)
    count = np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1
    row = np.repeat(np.arange(len(n)), count)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(inside * STRIDE, np.maximum(n[row] - WINDOW, 0))
    return row, first[:-1][row] + start, np.minimum(n[row], WINDOW)


def sequences(index: np.ndarray, start: np.ndarray, size: np.ndarray, blank: int) -> np.ndarray:
    """Windows as rows of word numbers; ``blank`` follows the last word."""
    column = np.arange(WINDOW)
    at = np.minimum(start[:, None] + column, max(len(index) - 1, 0))
    return np.where(column < size[:, None], index[at] if len(index) else blank, blank).astype(np.int32)


def initial(seed: int = 7) -> Parameters:
    rng = np.random.default_rng(seed)
    e, h = 2 * EMBEDDED, HIDDEN
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
    return {
        "word": (rng.standard_normal((WORDS, EMBEDDED)) * 0.1).astype(np.float32),
        "gram": (rng.standard_normal((GRAMS, EMBEDDED)) * 0.3).astype(np.float32),
        "w": scale(2, e, 3 * h), "b": np.zeros((2, 3 * h), np.float32), "u": scale(2, h, 3 * h),
        "a": scale(2 * h, POOLED), "v": scale(POOLED, 1)[:, 0], "o": scale(2 * h, 1)[:, 0], "c": np.zeros(1, np.float32)}


def embedded(p: Parameters, w: Words) -> np.ndarray:
    """Inputs of the distinct words."""
    size = np.diff(np.append(w.gram_first, len(w.gram)))[:, None]
    if not len(w.word):
        return np.zeros((0, 2 * EMBEDDED), np.float32)
    grams = np.add.reduceat(p["gram"][w.gram], w.gram_first, axis=0) / np.sqrt(size)
    return np.concatenate([p["word"][w.word], grams], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(p: Parameters, inputs: np.ndarray, seq: np.ndarray, keep: bool = False):
    """Logits of windows. ``inputs`` has the words' inputs, then one row of zeros for the blank."""
    n, h = len(seq), HIDDEN
    real = seq < len(inputs) - 1
    ragged = not real.all()
    table = np.einsum("we,dek->dwk", inputs, p["w"], optimize=True) + p["b"][:, None]
    states = np.empty((WINDOW, n, 2, h), np.float32)
    trace = []
    state = np.zeros((2, n, h), np.float32)
    for t in range(WINDOW):
        at = (t, WINDOW - 1 - t)
        x = np.stack([table[0][seq[:, at[0]]], table[1][seq[:, at[1]]]])
        r = state @ p["u"]
        gates = _sigmoid(x[..., : 2 * h] + r[..., : 2 * h])
        z, g = gates[..., :h], gates[..., h:]
        new = np.tanh(x[..., 2 * h :] + g * r[..., 2 * h :])
        out = new + z * (state - new)
        if ragged:
            out *= np.stack([real[:, at[0]], real[:, at[1]]])[..., None]
        if keep:
            trace.append((state, z, g, new, r[..., 2 * h :]))
        state = out
        states[at[0], :, 0], states[at[1], :, 1] = out[0], out[1]
    flat = states.reshape(WINDOW, n, 2 * h)
    hidden = np.tanh(flat @ p["a"])
    weight = hidden @ p["v"]
    if ragged:
        weight = np.where(real.T, weight, -30.0)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[..., None] * flat).sum(axis=0)
    logit = pooled @ p["o"] + p["c"]
    return (logit, (seq, real, table, flat, hidden, weight, pooled, trace)) if keep else logit


def gradients(p: Parameters, inputs: np.ndarray, kept: tuple, slope: np.ndarray) -> tuple[Parameters, np.ndarray]:
    """Gradients of the weights and of the inputs, from the slope of the loss at each logit."""
    seq, real, _, flat, hidden, weight, pooled, trace = kept
    n, h = len(seq), HIDDEN
    out = {"o": pooled.T @ slope, "c": np.array([slope.sum()])}
    d_pooled = slope[:, None] * p["o"]
    d_flat = weight[..., None] * d_pooled
    d_weight = (flat * d_pooled).sum(axis=-1)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0)) * real.T
    out["v"] = (hidden * d_score[..., None]).sum(axis=(0, 1))
    d_hidden = d_score[..., None] * p["v"] * (1 - hidden**2)
    out["a"] = flat.reshape(-1, 2 * h).T @ d_hidden.reshape(-1, POOLED)
    d_flat = (d_flat + d_hidden @ p["a"].T).reshape(WINDOW, n, 2, h)
    out["u"], d_table = np.zeros_like(p["u"]), np.zeros((2, len(inputs), 3 * h), np.float32)
    each = np.empty((2, WINDOW, n, 3 * h), np.float32)
    carried = np.zeros((2, n, h), np.float32)
    for t in range(WINDOW - 1, -1, -1):
        at = (t, WINDOW - 1 - t)
        state, z, g, new, r = trace[t]
        d = carried + np.stack([d_flat[at[0], :, 0], d_flat[at[1], :, 1]])
        d = d * np.stack([real[:, at[0]], real[:, at[1]]])[..., None]
        d_new = d * (1 - z) * (1 - new**2)
        d_z = d * (state - new) * z * (1 - z)
        d_g = d_new * r * g * (1 - g)
        d_x = np.concatenate([d_z, d_g, d_new], axis=-1)
        d_r = np.concatenate([d_z, d_g, d_new * g], axis=-1)
        out["u"] += state.transpose(0, 2, 1) @ d_r
        carried = d * z + d_r @ p["u"].transpose(0, 2, 1)
        each[0, at[0]], each[1, at[1]] = d_x
    order = np.argsort(seq.T, axis=None, kind="stable")
    found = seq.T.ravel()[order]
    begin = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    for k in (0, 1):
        d_table[k][found[begin]] = np.add.reduceat(each[k].reshape(-1, 3 * h)[order], begin, axis=0)
    d_table[:, -1] = 0
    out["b"] = d_table.sum(axis=1)
    out["w"] = np.einsum("we,dwk->dek", inputs, d_table, optimize=True)
    return out, np.einsum("dwk,dek->we", d_table, p["w"], optimize=True)


class Adam:
    def __init__(self, p: Parameters, rate: float) -> None:
        self.p, self.rate, self.step = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def apply(self, k: str, g: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        m, v = self.m[k], self.v[k]
        m[rows] = 0.9 * m[rows] + 0.1 * g
        v[rows] = 0.99 * v[rows] + 0.01 * g**2
        a, b = 1 - 0.9**self.step, 1 - 0.99**self.step
        self.p[k][rows] -= self.rate * (m[rows] / a) / (np.sqrt(v[rows] / b) + 1e-6)


def _step(p: Parameters, adam: Adam, w: Words, seq: np.ndarray, label: np.ndarray) -> None:
    used, local = np.unique(seq[seq < len(w.word)], return_inverse=True)
    own = np.full(seq.shape, len(used))
    own[seq < len(w.word)] = local
    ends = np.append(w.gram_first, len(w.gram))
    size = ends[used + 1] - ends[used]
    first = np.cumsum(size) - size
    place = np.repeat(ends[used] - first, size) + np.arange(size.sum())
    few = Words(w.index, w.first, w.word[used], w.gram[place], first)
    inputs = np.concatenate([embedded(p, few), np.zeros((1, 2 * EMBEDDED), np.float32)])
    logit, kept = forward(p, inputs, own, keep=True)
    slope = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
    found, d_inputs = gradients(p, inputs, kept, slope)
    adam.step += 1
    for k, g in found.items():
        adam.apply(k, np.clip(g, -1, 1).astype(np.float32))

    def table(k: str, rows: np.ndarray, g: np.ndarray) -> None:
        rows, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(rows), EMBEDDED), np.float32)
        np.add.at(total, at, g)
        adam.apply(k, total, rows)

    if len(used):
        table("word", few.word, d_inputs[:-1, :EMBEDDED])
        table("gram", few.gram, np.repeat(d_inputs[:-1, EMBEDDED:] / np.sqrt(size)[:, None], size, axis=0))


def logits(p: Parameters, w: Words, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    inputs = np.concatenate([embedded(p, w), np.zeros((1, 2 * EMBEDDED), np.float32)])
    out = np.empty(len(start), np.float32)
    for i in range(0, len(start), SCORED):
        part = slice(i, i + SCORED)
        out[part] = forward(p, inputs, sequences(w.index, start[part], size[part], len(w.word)))
    return out


def highest(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.maximum.reduceat(values, np.searchsorted(row, np.arange(rows))) if rows else values


@dataclass
class Model:
    parameters: Parameters
    slope: float
    shift: float

    def scores(self, column: pa.Array) -> np.ndarray:
        w = words(column)
        row, start, size = windows(w.first)
        top = highest(logits(self.parameters, w, start, size), row, len(column))
        return _sigmoid(self.slope * top.astype(np.float64) + self.shift)


def fit(texts: list[str], labels: np.ndarray, share: float, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """A network for texts with 0/1 labels; ``share`` is how often 1 occurs in the corpus."""
    rng = np.random.default_rng(seed)
    w = words(pa.array(texts, pa.large_string()))
    row, start, size = windows(w.first)
    count = np.bincount(row, minlength=len(texts))
    first = np.cumsum(count) - count
    p = initial(seed)
    adam = Adam(p, RATE)
    for epoch in range(epochs):
        chosen = first + (rng.random(len(texts)) * count).astype(np.int64)
        random = chosen
        if epoch >= 2 and epoch % 2 == 0:
            value = logits(p, w, start, size)
            order = np.lexsort((-value, row))
            top = order[first]
        if epoch >= 2:
            chosen = top
        extra = random[labels == 0] if epoch >= 2 else random[:0]
        at = rng.permutation(np.concatenate([chosen, extra]))
        adam.rate = RATE * (1 - epoch / (epochs + 1))
        for i in range(0, len(at), BATCH):
            part = at[i : i + BATCH]
            seq = sequences(w.index, start[part], size[part], len(w.word))
            _step(p, adam, w, seq, labels[row[part]].astype(np.float32))
    top = highest(logits(p, w, start, size), row, len(texts)).astype(np.float64)
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method, with a little weight decay
        q = _sigmoid(slope * top + shift)
        g = np.array([(weight * (q - labels) * top).sum() + slope, (weight * (q - labels)).sum()])
        d = weight * q * (1 - q)
        hess = np.array([[(d * top * top).sum() + 1, (d * top).sum()], [(d * top).sum(), d.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        slope, shift = slope - step[0], shift - step[1]
    return Model(p, float(max(slope, 1e-3)), float(shift))


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model | None:
    """A model from rows of ``labels`` (doc_id, toxic) and their texts; at most ``rows`` of either label."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(total) < 2:
        return None
    order = [F.xxhash64("doc_id"), "doc_id"]
    pick = [known.where(F.col("toxic") == k).orderBy(*order).limit(rows) for k in (0, 1)]
    few = pick[0].unionByName(pick[1])
    # At most 2 * rows ids of 12 bytes.
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").orderBy(*order, "toxic").collect()
    texts, label = [r["text"] or "" for r in found], np.array([r["toxic"] for r in found])
    if len(set(label.tolist())) < 2:
        return None
    return fit(texts, label, total[1] / (total[0] + total[1]))


def score(df: DataFrame, model: Model | None, carry: list[str], text: str = "text") -> DataFrame:
    """The columns ``carry``, then ``score`` (0 to 1), of every row."""
    kept = df.sparkSession.sparkContext.broadcast(model)  # the tables have a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            found = kept.value.scores(batch.column("_text")) if kept.value else np.full(batch.num_rows, 0.5)
            yield pa.record_batch([*batch.columns[: len(carry)], pa.array(found)], [*carry, "score"])

    rows = df.select(*carry, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(carry)])
    return rows.mapInArrow(run, f"{kinds}, score double")
