"""Language of a text by interpolated Kneser-Ney character models.

Texts are reduced to letters in lower case with one mark between words; every
letter is one of ``CODES`` codes (Latin letters have codes of their own, all
others share the rest by hash), so an n-gram of three codes is a 24-bit number
and a model of any corpus is bounded by the number of codes. n-grams of all
labelled documents are counted in tasks and added up in one aggregate.

A model holds sorted arrays of n-gram numbers with their probabilities,
interpolated with absolute discounts: the trigram with its count, the bigram
and unigram with the number of different letters seen before them. A text's
cross-entropy per letter is taken under every language; the least one wins.
The score is the share of the winner among exp(-SHARPNESS * cross-entropy).

A text without letters (null, empty, digits) is ``und`` with score 0. A text
is rejected when it is ``und`` or its cross-entropy is above the limit of its
language and length class (powers of two of the letters): that of nearly all
labelled documents of the class plus a margin. The labelled documents are split
in two by their texts, and each half is judged by the models of the other one,
so none by a model that saw it. A class of too few documents takes the limit of
all documents of its language that are not short, and a margin that is wider
for short texts. Rows are judged one by one, so ties, copies and skew do not
matter. Without labelled rows every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbook.llm.batches import chunks
from quillbook.session import materialise

UNKNOWN = "und"
CODES = 256
MARK = 0
DISCOUNT = 0.75
SHARPNESS = 8.0
#: Languages a model may have: more labels than that are not languages.
LANGUAGES = 512
#: Quantile of the cross-entropies that sets a limit, the documents it takes, and the margins in bits.
QUANTILE, ENOUGH, MARGIN, SHORT = 0.99, 1000, 0.5, 8.0
#: Length classes by bits of the number of letters, and the first one that is not short.
CLASSES, LONG = 33, 6
#: n-gram numbers of one task that are kept before they are added up.
HELD = 4_000_000


def _letter_codes() -> np.ndarray:
    """The code of every code point of the basic plane; 0 is no letter. Case folds."""
    codes = np.zeros(0x10000, np.uint8)
    for c in range(0x10000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()[0]
            o = ord(low)
            # a-z and the accented letters of Latin-1 keep codes of their own; the rest go by hash.
            codes[c] = o - 96 if 97 <= o <= 122 else o - 196 if 224 <= o <= 255 else 60 + o * 40503 % 65536 % (CODES - 60)
    return codes


_codes: np.ndarray | None = None


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each between two marks, and where each text starts."""
    global _codes
    if _codes is None:
        _codes = _letter_codes()
    points = [np.frombuffer((t or "").encode("utf-32-le", "replace"), np.uint32) for t in texts]
    sizes = np.fromiter((len(p) + 1 for p in points), np.int64, len(points))
    starts = np.cumsum(sizes) - sizes
    joined = np.zeros(int(sizes.sum()), np.uint8)
    for start, p in zip(starts, points, strict=True):
        wide = p >= 0x10000
        joined[start + 1 : start + 1 + len(p)] = _codes[np.where(wide, 0, p)]
        if wide.any():  # letters of the other planes share codes by hash
            joined[start + 1 : start + 1 + len(p)][wide] = [
                60 + c * 40503 % 65536 % (CODES - 60) if chr(c).isalpha() else 0 for c in p[wide]]
    keep = np.ones(len(joined), bool)
    keep[1:] = (joined[1:] != MARK) | (joined[:-1] != MARK)
    keep[starts] = True
    at = np.cumsum(keep) - 1
    return joined[keep], at[starts]


def trigrams(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the trigram that ends at each code (a mark stands before each text), and where texts start.

    A text of n letters has n + its words trigrams: the mark at its start predicts nothing.
    """
    padded = np.concatenate([codes, [MARK]]).astype(np.uint32)
    one = padded[:-1].copy()
    before = np.empty_like(one)
    before[0], before[1:] = MARK, one[:-1]
    before[starts] = MARK
    earlier = np.empty_like(one)
    earlier[:1], earlier[1:] = MARK, before[:-1]
    earlier[starts] = MARK
    return (earlier << 16) | (before << 8) | one, starts


@dataclass(frozen=True)
class Model:
    """Per language: sorted trigrams and bigrams with probabilities and the weight left to shorter contexts."""

    languages: list[str]
    tri: list[tuple[np.ndarray, np.ndarray]]
    left: list[tuple[np.ndarray, np.ndarray]]
    bi: list[tuple[np.ndarray, np.ndarray]]
    left_bi: list[np.ndarray]
    uni: list[np.ndarray]
    #: By language and length class.
    limits: np.ndarray

    def above(self, best: np.ndarray, bits: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Whether texts of ``found`` letters in languages ``best`` have more bits than their limits."""
        return bits > self.limits[best, np.minimum(np.frexp(found)[1], CLASSES - 1)]

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Cross-entropy in bits of each trigram under each language."""
        out = np.empty((len(keys), len(self.languages)), np.float32)
        pair, context, last = keys & 0xFFFF, keys >> 8, keys & 0xFF

        def found(where: tuple[np.ndarray, np.ndarray], what: np.ndarray, other: float) -> np.ndarray:
            index, values = where
            if not len(index):
                return np.full(len(what), other)
            at = np.minimum(np.searchsorted(index, what), len(index) - 1)
            return np.where(index[at] == what, values[at], other)

        for k in range(len(self.languages)):
            p1 = self.uni[k][last]
            p2 = found(self.bi[k], pair, 0.0) + self.left_bi[k][pair >> 8] * p1
            p3 = found(self.tri[k], keys, 0.0) + found(self.left[k], context, 1.0) * p2
            out[:, k] = -np.log2(p3)
        return out


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(values, first) if len(first) else values.astype(np.float64))


def estimate(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney from trigram counts per language."""
    languages = sorted(counts)
    tri, left, bi, left_bi, uni = [], [], [], [], []
    for language in languages:
        keys, n = counts[language]
        order = np.argsort(keys)
        keys, n = keys[order].astype(np.int64), n[order].astype(np.float64)
        contexts, total = _sums(keys >> 8, n)
        _, kinds = _sums(keys >> 8, np.ones(len(keys)))
        at = np.searchsorted(contexts, keys >> 8)
        tri.append((keys, np.maximum(n - DISCOUNT, 0) / total[at]))
        left.append((contexts, DISCOUNT * kinds / total))
        # A bigram's count is the number of different letters before it.
        pairs, before = _sums(keys & 0xFFFF, np.ones(len(keys)))
        total_bi = np.bincount(pairs >> 8, before, CODES)
        kinds_bi = np.bincount(pairs >> 8, minlength=CODES)
        bi.append((pairs, np.maximum(before - DISCOUNT, 0) / total_bi[pairs >> 8]))
        left_bi.append(np.where(total_bi > 0, DISCOUNT * kinds_bi / np.maximum(total_bi, 1), 1.0))
        heads = np.bincount(pairs & 0xFF, minlength=CODES).astype(np.float64)
        seen = heads > 0
        spare = DISCOUNT * seen.sum() / max(heads.sum(), 1)
        uni.append(np.maximum(heads - DISCOUNT, 0) / max(heads.sum(), 1) + max(spare, 1e-9) / CODES)
    return Model(languages, tri, left, bi, left_bi, uni, np.full((len(languages), CLASSES), np.inf))


def scored(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per letter and language of each text, and its letters."""
    codes, starts = letters(texts)
    keys, starts = trigrams(codes, starts)
    used = np.zeros(1 << 24, bool)
    used[keys] = True
    distinct = np.flatnonzero(used)
    slot = np.empty(1 << 24, np.uint32)
    slot[distinct] = np.arange(len(distinct), dtype=np.uint32)
    bits = model.bits(distinct)[slot[keys]]
    bits[starts] = 0
    sums = np.add.reduceat(bits, starts, axis=0, dtype=np.float64) if len(starts) else bits
    inside = np.diff(np.append(starts, len(keys))) - 1
    found = np.add.reduceat((codes != MARK).astype(np.int64), starts) if len(starts) else inside
    return sums / np.maximum(inside, 1)[:, None], found


def half(text: str) -> Column:
    """In which half of the labelled rows a text is; copies are in one."""
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def count_trigrams(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, half, key, n`` over all rows with a language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            return _sums(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

        def out() -> Iterator[pa.RecordBatch]:
            for (name, side), parts in held.items():
                keys, n = merged(parts)
                yield pa.record_batch([pa.array([name] * len(keys), pa.string()), pa.array([side] * len(keys), pa.int32()),
                                       pa.array(keys, pa.int32()), pa.array(n, pa.int64())], ["lang", "half", "key", "n"])

        size = 0
        for batch in chunks(batches, "text"):
            names = list(zip(batch.column("lang").to_pylist(), batch.column("half").to_pylist(), strict=True))
            texts = batch.column("text").to_pylist()
            for name in set(names):
                codes, starts = letters([t for t, x in zip(texts, names, strict=True) if x == name])
                keys, starts = trigrams(codes, starts)
                keys = np.delete(keys, starts)
                distinct, n = np.unique(keys, return_counts=True)
                held.setdefault(name, []).append((distinct.astype(np.int32), n.astype(np.int64)))
                size += len(distinct)
            if size > HELD:
                held = {name: [merged(parts)] for name, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > HELD // 2:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    rows = df.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), half(text).alias("half"), F.col(text).alias("text"))
    parts = rows.mapInArrow(counted, "lang string, half int, key int, n long")
    return parts.groupBy("lang", "half", "key").agg(F.sum("n").alias("n"))


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model from all rows of ``df`` with a language.

    A language has at most CODES**3 trigrams, of which a corpus uses some tens
    of thousands. Limits come from all rows, each judged by the models of the half it is not in.
    """
    counts = materialise(count_trigrams(df, text, lang), "trigrams")
    names = [r[0] for r in counts.select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not names:
        return None
    table = counts.toArrow().combine_chunks()
    label = table.column("lang").combine_chunks().dictionary_encode()
    known, label = label.dictionary.to_pylist(), label.indices.to_numpy()
    side, keys, n = (table.column(c).to_numpy() for c in ("half", "key", "n"))

    def model_of(sides: list[int]) -> Model:
        own = {x: (label == i) & np.isin(side, sides) for i, x in enumerate(known)}
        return estimate({x: _sums(keys[at], n[at]) for x, at in own.items() if at.any()})

    model = model_of([0, 1])
    rows = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    judged = [identify(rows.where(half("text") == i), model_of([1 - i]), ["lang"]) for i in (0, 1) if (side == 1 - i).any()]
    limits = np.full((len(model.languages), CLASSES), np.inf)
    if judged:
        own = reduce(DataFrame.unionByName, judged).where((F.col("lang") == F.col("lang_pred")) & (F.col("letters") > 0))
        size = F.least(F.length(F.bin("letters")), F.lit(CLASSES - 1)).alias("class")
        own = materialise(own.select("lang", size, "bits"), "calibration")
        least = F.percentile_approx("bits", QUANTILE, 10_000).alias("q")
        whole = {r["lang"]: r["q"] for r in own.where(F.col("class") >= LONG).groupBy("lang").agg(least).collect()}
        widest = max(whole.values(), default=np.inf)
        shorter = SHORT / np.sqrt(2.0 ** np.maximum(np.arange(CLASSES) - 1, 0))
        limits = np.array([whole.get(x, widest) + shorter for x in model.languages])
        classes = own.groupBy("lang", "class").agg(least, F.count(F.lit(1)).alias("n")).where(F.col("n") >= ENOUGH)
        for r in classes.collect():
            limits[model.languages.index(r["lang"]), r["class"]] = r["q"]
    return replace(model, limits=limits + MARGIN)


def identify(df: DataFrame, model: Model | None, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``carry``, then ``lang_pred, score, bits, letters, rejected``, for every row."""
    spark = df.sparkSession
    carry = carry or []
    kept = spark.sparkContext.broadcast(model) if model else None  # at most LANGUAGES * CODES**3 numbers, in fact some MB

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            if kept is None:
                found, bits = np.array([sum(c.isalpha() for c in t or "") for t in texts]), np.zeros((len(texts), 0))
                best = score = least = np.zeros(len(texts))
                names, high = [UNKNOWN] * len(texts), np.ones(len(texts), bool)
            else:
                m = kept.value
                bits, found = scored(m, texts)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(texts)), best]
                score = 1 / np.exp(-SHARPNESS * (bits - least[:, None])).sum(axis=1)
                score = np.where(found > 0, score, 0.0)
                names = [m.languages[b] if f else UNKNOWN for b, f in zip(best, found, strict=True)]
                high = m.above(best, least, found)
            columns = [batch.column(i) for i in range(len(carry))]
            yield pa.record_batch(
                [*columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(least, pa.float64()),
                 pa.array(found, pa.int64()), pa.array(high | (found == 0))],
                [*carry, "lang_pred", "score", "bits", "letters", "rejected"])

    rows = df.select(*carry, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(carry)])
    schema = (f"{kinds}, " if kinds else "") + "lang_pred string, score double, bits double, letters long, rejected boolean"
    return rows.mapInArrow(judged, schema)


def drop_rejected(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose language is known, with all their columns; no shuffle."""
    kept = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            if kept.value is not None:
                bits, found = scored(kept.value, batch.column(text).to_pylist())
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                high = kept.value.above(best, least, found)
                yield batch.filter(pa.array(~high & (found > 0)))

    return df.mapInArrow(run, df.schema)


def train_rows(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that may be learned from; every third one by the CRC of its id is held out."""
    return df.where(~held_out(key))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
