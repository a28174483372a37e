"""Benchmark items inside training texts: BM25 retrieval with block-max WAND, then a check of the overlap.

The test items are indexed: a posting list per word with the BM25 weight of
the word in each item, as a share of the item's score against itself, and the
largest weight of the list and of each block of it. Every document is cut
into overlapping passages of twice the longest item, so any run of words as
long as an item lies whole in a passage, and every passage is a query for all
items with at least ``threshold`` of their own score. A passage whose lists'
largest weights cannot reach that is done at once, and so is one where no
block's largest weights can (both for all passages of a batch together); the
others go through WAND: the pivot is the first item that can reach the
threshold, blocks that cannot are skipped.

An item that is retrieved is a leak when the passage holds enough of the word
runs of its question and of its answer. The answer is the last sentence (in
an item of one sentence the last third) and at least RUN words, the question
all before it.

Words are runs of letters, marks and digits of any script. Scripts without
blanks (Chinese, Japanese, Thai and others) and runs above LONG bytes have one
word at each character: that one and the next. An item of fewer than RUN words
is found where a text has exactly its words in a row, one without words never.

The index takes items in blocks of bounded size, one written pass per block,
and one block is built and held at a time. How many items have a word, the mean
and the longest length are those of all items, so blocks do not change what is
found. Null and empty texts hold no leak. Repeated rows are
judged each; rows without an id are found with id null.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbook.llm.batches import chunks, hashes, lowered, mixed, spans, utf8
from quillbook.session import materialise

K1, B = 1.2, 0.75
BLOCK = 4
RUN = 4
THRESHOLD, QUESTION, ANSWER = 0.6, 0.6, 0.5
#: Bytes of item texts in one index.
INDEX_BYTES = 1 << 20
#: Bytes of the longest run that is one word, and numbers in an index's table of largest weights.
LONG, TABLE = 64, 1 << 24
LETTER, UNSPACED = 1, 2
ALNUM = np.zeros(256, np.uint8)
ALNUM[48:58] = ALNUM[97:123] = LETTER
#: Scripts written without blanks between words.
WITHOUT_BLANKS = [
    (0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x3005, 0x3007), (0x3040, 0x30FF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
JOINERS = (0x200C, 0x200D)
_points: np.ndarray | None = None


def _kinds(data: np.ndarray) -> np.ndarray:
    """Of each byte of UTF-8 text: whether its character is part of a word, and of a script without blanks."""
    global _points
    if _points is None:
        _points = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0xE0200)], np.uint8)
        _points[list(JOINERS)] = LETTER
        for low, high in WITHOUT_BLANKS:
            _points[low : high + 1] *= UNSPACED
    kinds = ALNUM[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        size = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        point = (data[lead] & (0x7F >> size)).astype(np.int64)
        for j in range(1, 4):
            more = size > j
            point[more] = point[more] << 6 | data[lead[more] + j] & 63
        kind = _points[np.minimum(point, len(_points) - 1)]
        kinds[lead] = kind
        for j in range(1, 4):
            kinds[lead[size > j] + j] = kind[size > j]
    return kinds


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; in runs without blanks, two characters are a word, and words overlap."""
    kinds = _kinds(data)
    starts, ends, row = spans(kinds == LETTER, offsets)
    wide = ends - starts > LONG
    for i in np.flatnonzero(wide):
        kinds[starts[i] : ends[i]] = UNSPACED
    if (kinds == UNSPACED).any():
        runs_from, runs_to, runs_row = spans(kinds == UNSPACED, offsets)
        at = np.flatnonzero((kinds == UNSPACED) & ((data & 0xC0) != 0x80))
        run = np.searchsorted(runs_from, at, "right") - 1
        same = np.append(run[1:] == run[:-1], False)  # another character of the run follows
        end = runs_to[run]
        two = np.flatnonzero(same[:-1] & same[1:])
        end[two] = at[two + 2]
        kept = same | (at == runs_from[run])
        starts, ends, row = (np.concatenate([x[~wide], y[kept]]) for x, y in ((starts, at), (ends, end), (row, runs_row[run])))
        order = np.argsort(starts, kind="stable")
        starts, ends, row = starts[order], ends[order], row[order]
    return starts, ends, row


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z in lower case) of all rows, and where each row's start."""
    data, offsets = utf8(column)
    data = lowered(data)
    starts, ends, row = word_spans(data, offsets)
    return hashes(data, starts, ends), np.searchsorted(row, np.arange(len(offsets)))


def runs(w: np.ndarray, n: int = RUN) -> np.ndarray:
    """Hashes of every ``n`` words in a row; all words as one if there are fewer."""
    n = min(n, len(w))
    if not n:
        return w
    out = mixed(w[: len(w) - n + 1])
    for j in range(1, n):
        out = mixed(out + w[j : len(w) - n + 1 + j])
    return out


def answer_words(text: str, w: int) -> int:
    """How many of the ``w`` words of an item are its answer."""
    sentences = [len(words(pa.array([s]))[0]) for s in re.split(r"(?<=[.?!])\s+|(?<=[。？！।])|\n+", text)]
    sentences = [n for n in sentences if n]
    return max(RUN, sentences[-1] if len(sentences) > 1 else w // 3)


@dataclass
class Postings:
    items: list[int]
    weights: list[float]
    top: float = 0.0
    last: list[int] = field(default_factory=list)
    most: list[float] = field(default_factory=list)

    def close(self) -> None:
        self.top = max(self.weights)
        for i in range(0, len(self.items), BLOCK):
            self.last.append(self.items[i : i + BLOCK][-1])
            self.most.append(max(self.weights[i : i + BLOCK]))


@dataclass(frozen=True)
class Totals:
    """Of all items with at least RUN words: their number, mean and longest length, and words (sorted) with the items they are in."""

    items: int
    mean: float
    longest: int
    words: np.ndarray
    found: np.ndarray


class Index:
    """Items in memory; ``totals`` where they are a block of more items."""

    def __init__(self, rows: list[tuple[object, str]], threshold: float = THRESHOLD, totals: Totals | None = None) -> None:
        self.threshold = threshold - 1e-9
        self.ids, self.question, self.answer, terms = [], [], [], []
        short: dict[int, list[tuple[int, object]]] = {}
        for key, text in rows:
            w, _ = words(pa.array([text]))
            if 0 < len(w) < RUN:
                short.setdefault(len(w), []).append((int(runs(w, len(w))[0]), key))
            elif len(w):
                self.ids.append(key)
                terms.append(w)
                cut = max(RUN, len(w) - answer_words(text, len(w)))
                self.question.append(runs(w[:cut]))
                self.answer.append(runs(w[cut:] if len(w) - cut >= RUN else w[-RUN:]))
        self.longest = totals.longest if totals else max(map(len, terms), default=RUN)
        # Whole items of fewer than RUN words, by their number of words.
        self.short = {n: (np.array(sorted({h for h, _ in found}), np.uint64), found) for n, found in short.items()}
        n, mean = len(terms), float(np.mean([len(t) for t in terms])) if terms else 1.0
        counted = [np.unique(t, return_counts=True) for t in terms]
        self.vocabulary, df = np.unique(np.concatenate([c[0] for c in counted]), return_counts=True) if n else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64))
        every = n
        if totals:
            every, mean = totals.items, totals.mean
            df = totals.found[np.searchsorted(totals.words, self.vocabulary)]
        idf = np.log(1 + (every - df + 0.5) / (df + 0.5))
        lists: list[Postings] = [Postings([], []) for _ in df]
        for i, (found, tf) in enumerate(counted):
            at = np.searchsorted(self.vocabulary, found)
            score = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * tf.sum() / mean))
            for t, s in zip(at.tolist(), (score / score.sum()).tolist(), strict=True):
                lists[t].items.append(i)
                lists[t].weights.append(s)
        for postings in lists:
            postings.close()
        self.lists = lists
        self.top = np.array([p.top for p in lists] + [0.0])
        # Largest weight of a term in each run of BLOCK items, or of more where the table would be too large.
        per = max(BLOCK, -(-n * (len(lists) + 1) // TABLE))
        self.blocks = np.zeros((len(lists) + 1, max(1, -(-n // per))), np.float32)
        for t, p in enumerate(lists):
            np.maximum.at(self.blocks[t], np.array(p.items) // per, p.weights)

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items with a score of at least the threshold for a set of terms: block-max WAND."""
        lists = [self.lists[t] for t in terms]
        at = [0] * len(lists)
        found: list[tuple[int, float]] = []
        order = list(range(len(lists)))
        while True:
            order = sorted((k for k in order if at[k] < len(lists[k].items)), key=lambda k: lists[k].items[at[k]])
            bound, pivot = 0.0, -1
            for k in order:
                bound += lists[k].top
                if bound >= self.threshold:
                    pivot = lists[k].items[at[k]]
                    break
            if pivot < 0:
                return found
            inside = [k for k in order if lists[k].items[at[k]] <= pivot]
            beyond = [lists[k].items[at[k]] for k in order if lists[k].items[at[k]] > pivot]
            bound, upto = 0.0, min(beyond, default=len(self.ids))
            for k in inside:
                b = bisect_left(lists[k].last, pivot, at[k] // BLOCK)
                if b < len(lists[k].last):
                    bound += lists[k].most[b]
                    upto = min(upto, lists[k].last[b] + 1)
            if bound < self.threshold:
                target = max(upto, pivot + 1)
            elif lists[order[0]].items[at[order[0]]] == pivot:
                score = sum(lists[k].weights[at[k]] for k in inside)
                if score >= self.threshold:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for k in inside:
                at[k] = bisect_left(lists[k].items, target, at[k])

    def _by_blocks(self, passage: np.ndarray, term: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Those of the passages ``wanted`` (sorted) for which some block can reach the threshold."""
        at = np.searchsorted(wanted, passage)
        at[at == len(wanted)] = 0
        own = np.flatnonzero(wanted[at] == passage) if len(wanted) else wanted
        own = own[np.argsort(at[own], kind="stable")]
        out = []
        step = max(1, (1 << 22) // self.blocks.shape[1])
        starts = np.searchsorted(at[own], np.arange(len(wanted) + 1))
        low = 0
        while low < len(wanted):  # some million numbers at a time
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + step, "right")) - 1)
            part = own[starts[low] : starts[high]]
            sums = np.add.reduceat(self.blocks[term[part]], starts[low:high] - starts[low], axis=0)
            out.append(wanted[low:high][(sums.max(axis=1) >= self.threshold - 1e-5)])
            low = high
        return np.concatenate(out) if out else wanted

    def leaks(self, column: pa.Array) -> list[tuple[int, object, float, float, float]]:
        """Row, item id, score, and shares of question and answer found: the best passage of each row and item."""
        w, first = words(column)
        return self._indexed(w, first) + self._exact(w, first)

    def _exact(self, w: np.ndarray, first: np.ndarray) -> list[tuple[int, object, float, float, float]]:
        """Items of fewer than RUN words: rows that have these words in a row."""
        out = []
        for n, (wanted, items) in self.short.items():
            if len(w) < n:
                continue
            value = runs(w, n)
            at = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)] == value)
            row = np.searchsorted(first, at, "right") - 1
            inside = at + n <= first[row + 1]
            pairs = set(zip(row[inside].tolist(), value[at[inside]].tolist(), strict=True))
            keys: dict[int, list[object]] = {}
            for h, key in items:
                keys.setdefault(h, []).append(key)
            out += [(r, key, 1.0, 1.0, 1.0) for r, h in sorted(pairs) for key in keys[h]]
        return out

    def _indexed(self, w: np.ndarray, first: np.ndarray) -> list[tuple[int, object, float, float, float]]:
        if not len(w) or not len(self.vocabulary):
            return []
        term = np.minimum(np.searchsorted(self.vocabulary, w), len(self.vocabulary) - 1)
        term[self.vocabulary[term] != w] = len(self.vocabulary)
        known = np.flatnonzero(term < len(self.vocabulary))
        if not len(known):
            return []
        row = np.searchsorted(first, known, "right") - 1
        step = self.longest
        inside = known - first[row]
        # Passage j of a row holds the words from j * step to (j + 2) * step; a word is in passage j and j - 1.
        cells = np.maximum(np.diff(first) - 1, 0) // step + 1
        base = np.cumsum(cells) - cells
        cell = base[row] + inside // step
        # A term counts once in a passage: where its last occurrence in the row lies before the passage.
        order = np.lexsort((known, term[known], row))
        same = np.zeros(len(known), bool)
        same[1:] = (row[order][1:] == row[order][:-1]) & (term[known][order][1:] == term[known][order][:-1])
        before = np.full(len(known), -1, np.int64)
        before[order[1:]] = np.where(same[1:], cell[order][:-1], -1)
        total = int(cells.sum())
        new, also = before < cell, (before < cell - 1) & (inside >= step)
        passage = np.concatenate([cell[new], cell[also] - 1])
        held = np.concatenate([term[known[new]], term[known[also]]])
        bound = np.bincount(passage, self.top[held], total)
        wanted = self._by_blocks(passage, held, np.flatnonzero(bound >= self.threshold))
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for c in wanted.tolist():
            r = int(np.searchsorted(base, c, "right") - 1)
            start = int(first[r] + (c - base[r]) * step)
            end = min(start + 2 * step, int(first[r + 1]))
            here = np.unique(term[start:end])
            shingles = None
            for item, score in self.retrieve(here[here < len(self.vocabulary)].tolist()):
                shingles = runs(w[start:end]) if shingles is None else shingles
                q, a = (float(np.isin(x[item], shingles).mean()) if len(x[item]) else 1.0 for x in (self.question, self.answer))
                if q >= QUESTION and a >= ANSWER and score > best.get((r, item), (0.0,))[0]:
                    best[r, item] = (score, q, a)
        return [(r, self.ids[item], *v) for (r, item), v in sorted(best.items())]


class Indexes(Sequence):
    """Indexes over blocks of items, each built when it is asked for."""

    def __init__(self, rows: DataFrame, blocks: int, threshold: float) -> None:
        self.rows, self.blocks, self.threshold = rows, blocks, threshold
        if blocks > 1:
            self._count()

    def _count(self) -> None:
        """Totals over all items, and the number of items of each word by the blocks that need it."""

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, "t"):
                w, first = words(batch.column("t"))
                sets = [np.unique(w[i:j]).view(np.int64) if j - i >= RUN else w[:0].view(np.int64)
                        for i, j in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch([batch.column("block"), pa.array(np.diff(first), pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                      ["block", "length", "words"])

        items = materialise(self.rows.mapInArrow(cut, "block int, length long, words array<long>"), "item-words")
        items = items.where(F.col("length") >= RUN)
        self.items, total, self.longest = items.agg(F.count(F.lit(1)), F.sum("length"), F.max("length")).first()
        self.mean, self.longest = (total / self.items, self.longest) if self.items else (1.0, RUN)
        of = items.select("block", F.explode("words").alias("word")).groupBy("word", "block").agg(F.count(F.lit(1)).alias("n"))
        of = materialise(of, "block-words")
        self.found = materialise(of.select("word", "block").join(
            of.groupBy("word").agg(F.sum("n").alias("n")), "word").select("block", "word", "n"), "word-items")

    def __len__(self) -> int:
        return self.blocks

    def __getitem__(self, b: int) -> Index:
        if not 0 <= b < self.blocks:
            raise IndexError(b)
        totals = None
        if self.blocks > 1:
            table = self.found.where(F.col("block") == b).toArrow()
            own, n = table.column("word").to_numpy().view(np.uint64), table.column("n").to_numpy()
            order = np.argsort(own)
            totals = Totals(self.items, self.mean, self.longest, own[order], n[order])
        return Index([(r["k"], r["t"]) for r in self.rows.where(F.col("block") == b).orderBy("k", "t").collect()],
                     self.threshold, totals)


def indexes(items: DataFrame, key: str = "item_id", text: str = "text", threshold: float = THRESHOLD) -> Indexes:
    """Indexes over all items, each over some INDEX_BYTES of text."""
    rows = items.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // INDEX_BYTES)
    return Indexes(rows.withColumn("block", F.pmod(F.xxhash64("t"), F.lit(max(blocks, 1))).cast("int")), blocks, threshold)


def leaks(df: DataFrame, found: Sequence[Index], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, question, answer`` of every document that holds an item."""
    schema = "doc_id long, item_id long, score double, question double, answer double"
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = []
    for one in found:
        index = df.sparkSession.sparkContext.broadcast(one)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, "text"):
                hits = index.value.leaks(batch.column("text"))
                columns = list(zip(*hits, strict=True)) or [()] * 5
                ids = batch.column("doc_id").take(pa.array(columns[0], pa.int64()))
                yield pa.record_batch([ids, pa.array(columns[1], pa.int64()), *[pa.array(c, pa.float64()) for c in columns[2:]]],
                                      ["doc_id", "item_id", "score", "question", "answer"])

        parts.append(rows.mapInArrow(run, schema))
        if len(found) > 1:
            parts[-1] = materialise(parts[-1], "leaks")
            index.destroy()
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], schema)


def drop_leaks(df: DataFrame, found: Sequence[Index], text: str = "text") -> DataFrame:
    """``df`` without the documents that hold an item; no shuffle."""
    for one in found:
        index = df.sparkSession.sparkContext.broadcast(one)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, text):
                clean = np.ones(batch.num_rows, bool)
                clean[[h[0] for h in index.value.leaks(batch.column(text))]] = False
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(run, df.schema)
        if len(found) > 1:
            df = materialise(df, "clean")
            index.destroy()
    return df
