"""Helpers for tasks that work on Arrow batches: bounded chunks, and words as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows in them; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with at most ``limit`` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def spans(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes for which ``part`` holds; no run passes the end of its row."""
    if not len(part):
        none = np.zeros(0, np.int64)
        return none, none, none
    inner = offsets[(offsets > 0) & (offsets < len(part))]
    first = part.copy()
    first[1:] &= ~part[:-1]
    first[inner] = part[inner]
    last = part.copy()
    last[:-1] &= ~part[1:]
    last[inner - 1] = part[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on each other."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64; tables up to 2 million entries are kept."""
    kept = _powers.get(base)
    if kept is not None and len(kept) >= n:
        return kept
    out = np.empty(1 << max(16, int(n - 1).bit_length()), np.uint64)
    out[0], done = 1, 1
    while done < len(out):
        out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
        done *= 2
    if len(out) <= 1 << 21:
        _powers[base] = out
    return out


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial, read off one running sum, then mixed.

    Long data is taken in runs of spans, so the sums stay small.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    if ends[-1] - starts[0] > CHUNK_BYTES and len(starts) > 1:
        half = int(np.clip(np.searchsorted(starts, (starts[0] + ends[-1]) // 2), 1, len(starts) - 1))
        return np.concatenate([hashes(data, starts[:half], ends[:half]), hashes(data, starts[half:], ends[half:])])
    data, starts, ends = data[starts[0] : ends[-1]], starts - starts[0], ends - starts[0]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[: len(data)], out=total[1:])
    # The sum over a span holds the power of its start; the inverse takes that out.
    value = (total[ends] - total[starts]) * powers(INVERSE, len(data))[starts]
    return mixed(value + (ends - starts).astype(np.uint64) * MIX2)
