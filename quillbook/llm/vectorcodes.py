"""Vectors compressed to one code per part, with codebooks trained in whole numbers.

Vectors are cut into equal consecutive parts. Per part position a codebook of a
few entries is trained over the distinct parts, each weighing as often as it
occurs. Distinct parts are range partitioned and sorted by position and
components, so that the parts of a task are the leaves of a lexicographic trie:
parts that begin alike stand side by side. The trie is walked depth first with
one vector of sums on the path, the squared distances of all entries over the
dimensions read so far; what parts share at their beginning is added up once.
Subtrees of at most ``LEAVES`` parts are walked one depth at a time, all their
nodes together. A leaf takes the nearest entry, the lower one of equals, and
adds its components, times its weight, to that entry's sums. Only these sums
(entries x dimensions a task and position) travel; the codebooks themselves are
a few kilobytes.

Rows whose vector is null or holds null, infinite or not-a-number components go.
Shorter vectors count as filled up with zeros to the longest one, rounded up to
a multiple of the parts. A component x is the whole number floor(scale * x),
held within +-2**62; where sums might pass 64 bits, exact big integers are used,
and an error beyond a long is the largest long. Rows without id never start a
codebook; with fewer rows than entries, codebooks have fewer entries. Repeated
rows count as often as they come. An empty table has no codes, and no codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbook.session import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components stay within this, and a subtree of the trie has at most so many parts when it is walked by depth.
LIMIT, LEAVES = 1 << 62, 2048
LARGEST = (1 << 63) - 1


class Nearest(NamedTuple):
    entry: np.ndarray
    distance: np.ndarray


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite numbers, within the limit."""
    scaled = np.floor(np.clip(values.astype(np.float64), -LIMIT, LIMIT) * scale)
    over = np.abs(scaled) >= LIMIT
    return np.where(over, np.where(scaled > 0, LIMIT, -LIMIT), np.where(over, 0, scaled).astype(np.int64))


def _wide(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit numbers, or as big integers where squared distances need more."""
    top = max((int(np.abs(x).max()) for x in (parts, book) if x.size), default=0)
    kind = np.int64 if parts.shape[1] * (2 * top) ** 2 < LARGEST else object
    return parts.astype(kind), book.astype(kind)


def walk(parts: np.ndarray, book: np.ndarray, leaves: int = LEAVES) -> Nearest:
    """Nearest entry of ``book`` (entries, width), and distance, of each row of ``parts``: distinct, in lexicographic order."""
    parts, book = _wide(parts, book)
    n, width = parts.shape
    entry, distance = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    if not n:
        return Nearest(entry, distance)
    # The dimension at which a part leaves the one before it: there a new branch begins.
    branch = np.concatenate([[0], (parts[1:] != parts[:-1]).argmax(axis=1)]) if n > 1 else np.zeros(1, np.int64)
    path = [(0, n, 0, np.zeros((1, len(book)), parts.dtype))]
    while path:
        first, last, depth, sums = path.pop()
        if last - first <= leaves or depth == width:
            below = branch[first:last]
            at = np.array([first])
            for d in range(depth, width):
                begins = below <= d
                begins[0] = True
                nodes = first + np.flatnonzero(begins)
                parent = np.searchsorted(at, nodes, "right") - 1
                sums, at = sums[parent] + (parts[nodes, d, None] - book[:, d]) ** 2, nodes
            best = sums.argmin(axis=1)
            entry[at], distance[at] = best, sums[np.arange(len(at)), best]
            continue
        begins = branch[first:last] <= depth
        begins[0] = True
        nodes = first + np.flatnonzero(begins)
        ends = np.append(nodes[1:], last)
        for a, b in zip(nodes[::-1].tolist(), ends[::-1].tolist(), strict=True):  # the first child is walked next
            path.append((a, b, depth + 1, sums + (parts[a, depth] - book[:, depth]) ** 2))
    return Nearest(entry, distance)


def distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, which one each row is, and how often each occurs."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    ranked = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    number = np.cumsum(new) - 1
    back = np.empty(len(parts), np.int64)
    back[order] = number
    return ranked[new], back, np.bincount(number, minlength=int(new.sum()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of ``width``, shorter ones filled up with zeros."""
    column = column.cast(pa.large_list(column.type.value_type))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def kept(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, vector, label`` of the rows whose vector has finite components only."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
                     F.col(label).alias("label"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)))


def _parts(rows: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """``position, part, n``: distinct parts, in sorted runs; equal ones stand side by side, with a row for each batch."""
    own = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = whole(_matrix(batch.column("vector"), width), scale)
            for p in range(parts):
                found, _, n = distinct(values[:, p * own : (p + 1) * own])
                ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * own)
                yield pa.record_batch([pa.array(np.full(len(found), p, np.int32)), pa.ListArray.from_arrays(ends, pa.array(found.ravel())),
                                       pa.array(n)], ["position", "part", "n"])

    made = rows.select("vector").mapInArrow(run, "position int, part array<long>, n long")
    ranged = made.repartitionByRange("position", "part").sortWithinPartitions("position", "part")
    return materialise(ranged, "parts")


def _totals(parts: DataFrame, books: list[np.ndarray], own: int) -> DataFrame:
    """``position, entry, dimension, n, high, low``: sums of the parts nearest to each entry, as two halves of 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros((len(b), own), object) for b in books]
        for batch in batches:
            position = batch.column("position").to_numpy()
            values, times = _matrix(batch.column("part"), own), batch.column("n").to_numpy()
            for p in np.unique(position).tolist():
                here = position == p
                found, back, _ = distinct(values[here])  # in order already; joins what several batches had
                weight = np.bincount(back, times[here], len(found)).astype(np.int64)
                entry = walk(found, books[p]).entry
                n[p] += np.bincount(entry, weight, len(books[p])).astype(np.int64)
                top = int(np.abs(found).max()) * int(weight.sum()) if found.size else 0
                found = found if top < LARGEST else found.astype(object)
                order = np.argsort(entry, kind="stable")
                begin = np.flatnonzero(np.diff(entry[order], prepend=-1))
                total = np.add.reduceat((found * weight[:, None])[order], begin, axis=0)
                sums[p][entry[order][begin]] += total.astype(object)
        rows = [(p, k, d, int(n[p][k]), int(sums[p][k, d]) >> 32, int(sums[p][k, d]) & 0xFFFFFFFF)
                for p in range(len(books)) for k in np.flatnonzero(n[p]).tolist() for d in range(own)]
        names = ["position", "entry", "dimension", "n", "high", "low"]
        kinds = [pa.int32()] * 3 + [pa.int64()] * 3
        # The upper half of a sum of that many rows is below 2**63.
        yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    found = parts.mapInArrow(run, "position int, entry int, dimension int, n long, high long, low long")
    return found.groupBy("position", "entry", "dimension").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))


def train(
    rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> list[np.ndarray]:
    """Codebooks (entries, width of a part) per part position; ``rows`` as :func:`kept` gives them, written."""
    own = width // parts
    few = rows.where("vec_id is not null").orderBy("vec_id", "vector").limit(entries).collect()  # so many rows
    start = np.zeros((len(few), width))
    for i, r in enumerate(few):
        start[i, : len(r["vector"])] = r["vector"]
    books = [whole(start, scale)[:, p * own : (p + 1) * own] for p in range(parts)]
    if not len(few):  # no row has an id
        return [np.zeros((1, own), np.int64)] * parts
    made = _parts(rows, width, parts, scale)
    for _ in range(rounds):
        new = [b.copy() for b in books]
        for r in _totals(made, books, own).collect():  # parts x entries x dimensions rows
            new[r["position"]][r["entry"], r["dimension"]] = ((r["high"] << 32) + r["low"]) // r["n"]
        if all((a == b).all() for a, b in zip(new, books, strict=True)):
            break  # nothing moves any more
        books = new
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def coded(rows: DataFrame, books: list[np.ndarray], width: int, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error``: the entry of each part as two hexadecimal digits, and the sum of squared distances."""
    parts, own = len(books), width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = whole(_matrix(batch.column("vector"), width), scale)
            chosen, error = np.empty((len(values), parts), np.uint8), np.zeros(len(values), object)
            for p, book in enumerate(books):
                found, back, _ = distinct(values[:, p * own : (p + 1) * own])
                near = walk(found, book)
                chosen[:, p] = near.entry[back]
                error += near.distance[back].astype(object)
            codes = [c.tobytes().hex() for c in chosen]
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                                   pa.array([min(int(e), LARGEST) for e in error], pa.int64())],
                                  ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long")


def compress(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes and errors of all kept rows, written, and the codebooks. At most 256 entries."""
    rows = kept(df, key, vector, label)
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    width = -(-max(longest or 0, 1) // parts) * parts
    books = train(rows, width, parts, entries, rounds, scale) if longest is not None else []
    if not books:
        return df.sparkSession.createDataFrame([], f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"), []
    return materialise(coded(rows, books, width, scale), "codes"), books


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the errors of all rows of a label; rows without label are one label."""
    error = F.sum(F.col("error").cast("decimal(38,0)"))
    of = materialise(codes.groupBy(F.col("label").alias("_label")).agg(
        F.least(error, F.lit(LARGEST)).cast("long").alias("label_error")), "label-errors")
    return codes.join(of, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
