"""Texts as seekable compressed frames, and fill-in-the-middle over them.

A text is stored as zstandard frames that are independent of each other, one
after the other in ``data`` (which any zstandard reader can read as a whole),
with two arrays of cumulative counts: ``units`` (code points) and ``ends``
(compressed bytes) up to the end of each frame. A range of code points is found
by bisection; only the frames that it cuts are decompressed, frames that lie
inside it are copied as they are. Digests read the frames in order, one at a
time, so no text is ever whole in memory besides its compressed form.

A text is cut into prefix, middle and suffix at two places drawn from the
hash of its id and put together again with ``<P>``, ``<S>`` and ``<M>``; some
stay plain, as do texts that hold one of these strings and empty ones. The
parts of an output are told by these strings alone: they begin with the only
``<`` they have, so no text around them makes another one at a seam.

A null text is empty. A row without id hashes as an empty id. Repeated rows
give equal rows; only id and text are read, other columns may have any names.
Bytes that are not UTF-8 count as code points where a sequence begins.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbook.llm.batches import chunks, utf8
from quillbook.session import materialise

#: Bytes of text in a frame, and how many decompressed frames of a text are kept while it is worked on.
FRAME, KEPT = 1 << 15, 4
LEVEL = 1
STORED = "data binary, units array<long>, ends array<long>"
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Order of the parts in the output: their marks.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


def units_of(raw: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def unit_offset(raw: bytes, unit: int) -> int:
    """Byte at which code point ``unit`` of ``raw`` begins; the end when there are fewer."""
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return int(starts[unit]) if unit < len(starts) else len(raw)


class Frames(NamedTuple):
    data: bytes
    units: list[int]
    ends: list[int]


class Writer:
    """Puts a text together from pieces of text and frames that exist already."""

    def __init__(self) -> None:
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self.reset()

    def reset(self) -> None:
        self.open, self.size, self.data, self.units, self.ends = [], 0, [], [], []

    def frame(self, data: bytes, units: int) -> None:
        self._close()
        self._add(data, units)

    def _add(self, data: bytes, units: int) -> None:
        self.data.append(data)
        self.units.append((self.units[-1] if self.units else 0) + units)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(data))

    def text(self, raw: bytes) -> None:
        if raw:
            self.open.append(raw)
            self.size += len(raw)
            if self.size > FRAME:
                self._close(all=False)

    def _close(self, all: bool = True) -> None:
        raw, at = b"".join(self.open), 0
        while len(raw) - at > (0 if all else FRAME):
            end = min(at + FRAME, len(raw))
            for _ in range(3):  # a code point has at most three further bytes
                if end < len(raw) and raw[end] & 0xC0 == 0x80:
                    end -= 1
            self._add(self.compress(raw[at:end]), units_of(raw[at:end]))
            at = end
        self.open, self.size = ([raw[at:]], len(raw) - at) if at < len(raw) else ([], 0)

    def done(self) -> Frames:
        self._close()
        made = Frames(b"".join(self.data), self.units, self.ends)
        self.reset()
        return made


class Reader:
    """One stored text; keeps the last few frames it decompressed."""

    def __init__(self, frames: Frames, decompress: Callable[[bytes], bytes]) -> None:
        self.frames, self.decompress, self.kept = frames, decompress, {}

    def __len__(self) -> int:
        return len(self.frames.ends)

    def packed(self, i: int) -> bytes:
        return self.frames.data[self.frames.ends[i - 1] if i else 0 : self.frames.ends[i]]

    def raw(self, i: int) -> bytes:
        if i not in self.kept:
            if len(self.kept) >= KEPT:
                self.kept.pop(next(iter(self.kept)))
            self.kept[i] = self.decompress(self.packed(i))
        return self.kept[i]

    def copy(self, start: int, stop: int, out: Writer) -> None:
        """Code points from ``start`` up to ``stop``: whole frames as they are, cut ones by their text."""
        units = self.frames.units
        i = bisect.bisect_right(units, start)
        while start < stop:
            first, last = units[i - 1] if i else 0, units[i]
            if start == first and stop >= last:
                out.frame(self.packed(i), last - first)
            else:
                raw = self.raw(i)
                out.text(raw[unit_offset(raw, start - first) : unit_offset(raw, stop - first)])
            start, i = last, i + 1


@functools.lru_cache(maxsize=1)
def _decompress() -> Callable[[bytes], bytes]:
    return zstandard.ZstdDecompressor().decompress


def _arrays(made: list[Frames]) -> list[pa.Array]:
    return [pa.array([f.data for f in made], pa.binary()), pa.array([f.units for f in made], pa.list_(pa.int64())),
            pa.array([f.ends for f in made], pa.list_(pa.int64()))]


def _stored(batch: pa.RecordBatch) -> Iterator[Reader]:
    columns = [batch.column(c) for c in ("data", "units", "ends")]
    for data, units, ends in zip(*columns, strict=True):
        yield Reader(Frames(data.as_buffer().to_pybytes(), units.as_py(), ends.as_py()), _decompress())


def store(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts as frames, written: ``doc_id, n`` (code points)``, marked`` (holds a mark)``, data, units, ends``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer()
        for batch in chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            made, marked = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                raw = data[a:b].tobytes()
                out.text(raw)
                made.append(out.done())
                marked.append(any(m in raw for m in MARKS))
            n = pa.array([f.units[-1] if f.units else 0 for f in made], pa.int64())
            yield pa.record_batch([batch.column("doc_id"), n, pa.array(marked, pa.bool_()), *_arrays(made)],
                                  ["doc_id", "n", "marked", "data", "units", "ends"])

    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(run, f"doc_id long, n long, marked boolean, {STORED}"), "frames")


def plans(stored: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """``stored`` with ``form``, and ``low`` and ``high``: where prefix and middle end.

    ``plain`` of a hundred texts stay plain, ``spm`` of a hundred others have the suffix first.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    places = [d % (F.col("n") + 1) for d in drawn[:2]]
    whole = (F.col("n") == 0) | F.col("marked") | (drawn[2] % 100 >= 100 - plain)
    return stored.withColumn("_digest", digest).withColumns({
        "form": F.when(whole, "plain").when(drawn[3] % 100 < spm, "spm").otherwise("psm"),
        "low": F.least(*places), "high": F.greatest(*places)}).drop("_digest")


def composed(planned: DataFrame) -> DataFrame:
    """The outputs as frames: ``doc_id, n, form, low, high, data, units, ends``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer()
        for batch in chunks(batches, "data"):
            made, form = [], batch.column("form").to_pylist()
            n, low, high = (batch.column(c).to_pylist() for c in ("n", "low", "high"))
            for i, reader in enumerate(_stored(batch)):
                if form[i] == "plain":
                    made.append(reader.frames)
                    continue
                span = {PREFIX: (0, low[i]), MIDDLE: (low[i], high[i]), SUFFIX: (high[i], n[i])}
                for mark in ORDERS[form[i]]:
                    out.text(mark)
                    reader.copy(*span[mark], out)
                made.append(out.done())
            own = [batch.column(c) for c in ("doc_id", "n", "form", "low", "high")]
            yield pa.record_batch([*own, *_arrays(made)], ["doc_id", "n", "form", "low", "high", "data", "units", "ends"])

    rows = planned.select("doc_id", "n", "form", "low", "high", "data", "units", "ends")
    return rows.mapInArrow(run, f"doc_id long, n long, form string, low long, high long, {STORED}")


def _parts(reader: Reader, form: str, see: Callable[[bytes], None]) -> list[tuple[int, int]]:
    """Byte ranges of the original text in its order; ``see`` gets every frame in the order of the output."""
    marks = list(ORDERS.get(form, ()))
    found: dict[bytes, int] = {}
    at, tail = 0, b""
    for i in range(len(reader)):
        raw = reader.raw(i)
        see(raw)
        window, start = tail + raw, at - len(tail)
        place = 0
        while marks and (place := window.find(marks[0], place)) >= 0:
            found[marks.pop(0)] = start + place
            place += 3
        at += len(raw)
        # What may be the beginning of a mark is seen again, but nothing that was found already.
        done = max((p + 3 for p in found.values()), default=0)
        tail = window[-2:] if at - 2 >= done else window[len(window) - max(at - done, 0):]
    if marks:
        return [(0, at)]
    order = ORDERS.get(form, ())
    if not order:
        return [(0, at)]
    ends = {m: found[order[k + 1]] if k + 1 < len(order) else at for k, m in enumerate(order)}
    return [(found[m] + 3, ends[m]) for m in (PREFIX, MIDDLE, SUFFIX)]


def _stream(reader: Reader, sizes: list[int], start: int, stop: int, see: Callable[[bytes], None]) -> None:
    """The bytes from ``start`` up to ``stop``, frame by frame; ``sizes`` are cumulative."""
    i = bisect.bisect_right(sizes, start)
    while start < stop:
        first = sizes[i - 1] if i else 0
        see(reader.raw(i)[start - first : stop - first])
        start, i = sizes[i], i + 1


def read_back(reader: Reader, form: str, output: Callable[[bytes], None], restored: Callable[[bytes], None]) -> None:
    """Send the output, and the text rebuilt from it, to two consumers, frame by frame."""
    sizes: list[int] = []

    def see(raw: bytes) -> None:
        sizes.append((sizes[-1] if sizes else 0) + len(raw))
        output(raw)

    for start, stop in _parts(reader, form, see):
        _stream(reader, sizes, start, stop, restored)


def digests(outputs: DataFrame) -> DataFrame:
    """``doc_id, n, form, low, high, output_sha256, restored_sha256``: both streamed from the frames of the output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "data"):
            own = [batch.column(c) for c in ("doc_id", "n", "form", "low", "high")]
            found: list[tuple[str, str]] = []
            for reader, form in zip(_stored(batch), batch.column("form").to_pylist(), strict=True):
                a, b = hashlib.sha256(), hashlib.sha256()
                read_back(reader, form, a.update, b.update)
                found.append((a.hexdigest(), b.hexdigest()))
            yield pa.record_batch([*own, *(pa.array([f[k] for f in found], pa.string()) for k in (0, 1))],
                                  ["doc_id", "n", "form", "low", "high", "output_sha256", "restored_sha256"])

    return outputs.mapInArrow(
        run, "doc_id long, n long, form string, low long, high long, output_sha256 string, restored_sha256 string")


def texts(stored: DataFrame) -> DataFrame:
    """``doc_id, text`` of stored texts or outputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "data"):
            whole = [b"".join(map(r.raw, range(len(r)))) for r in _stored(batch)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(whole, pa.binary()).cast(pa.string(), safe=False)],
                                  ["doc_id", "text"])

    return stored.select("doc_id", "data", "units", "ends").mapInArrow(run, "doc_id long, text string")


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, plain: int = 10, spm: int = 20
) -> DataFrame:
    """The outputs of all rows as frames; see :func:`plans` for the shares and :func:`texts` for reading them."""
    return composed(plans(store(df, key, text), seed, plain, spm))
