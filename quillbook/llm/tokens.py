"""Tokens of texts for a byte-level BPE vocabulary.

A pre-token that is itself an entry of the vocabulary and encodes alone as
that entry is one token; which entries do so is proved once, by encoding
them all. Only the other pre-tokens are merged, all new ones of a run at once.
A task numbers the pre-tokens it meets and keeps their tokens in arrays, so a
run of text is one look-up per pre-token and one gather; when too many are
kept, those that came once go first.

Where a text is cut depends on the class of its code points (letter, number,
space, other), which is read off the library's own pre-tokenizer: for a whole
block of code points when the first of them comes up.

Null and empty texts have no tokens. A string of a special token inside a
text is that token, as the library reads it. Rows are counted one by one,
so repeated rows, ties and skew do not matter.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbook.llm.batches import chunks

#: Code points whose class is learned together.
BLOCK = 256
#: Pre-tokens a task remembers, characters it splits at once, and pre-tokens it looks up at once.
REMEMBERED, RUN, LOOKED_UP = 600_000, 1 << 20, 250_000
#: Bytes of the pre-tokens that are merged together; longer ones are left to the library.
WIDTHS = (8, 16, 32)
SURROGATES = range(0xD800, 0xE000)


def _class(found: list[int]) -> str:
    """Code points (sorted) as ranges of a character class."""
    points = np.array(found, np.int64)
    cuts = np.flatnonzero(np.diff(points) > 1)
    first, last = points[np.append(0, cuts + 1)], points[np.append(cuts, len(points) - 1)]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(first, last, strict=True))


class PreTokens:
    """The library's pre-tokens, its special strings and its merges, for one vocabulary file."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kinds: dict[str, list[int]] = {"letter": [], "number": [], "space": [], "other": []}
        self.blocks: set[int] = set()
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = added
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.learn(map(chr, range(BLOCK)))

    def learn(self, characters: Iterator[str]) -> None:
        """Classes of the blocks that the characters are in, and the patterns for all that are known."""
        pieces = lambda s: len(self.library.pre_tokenizer.pre_tokenize_str(s))
        for block in sorted({ord(x) // BLOCK for x in characters} - self.blocks):
            self.blocks.add(block)
            for c in range(block * BLOCK, (block + 1) * BLOCK):
                x = chr(c) if c not in SURROGATES else "?"
                kind = ("letter" if pieces(f"a{x}b") == 1 else "number" if pieces(f"1{x}2") == 1
                        else "other" if pieces(f"#{x}#") == 1 else "space")
                self.kinds[kind].append(c)
        letter, number, space = (_class(sorted(self.kinds[k])) for k in ("letter", "number", "space"))
        self.pattern = re.compile(
            f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            f"|[{space}]+(?![^{space}])|[{space}]+")
        self.unknown = re.compile(f"[^{_class(sorted(c for k in self.kinds.values() for c in k))}]")

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a stretch of text."""
        if not text.isascii() and self.unknown.search(text):
            self.learn(set(self.unknown.findall(text)))
        return self.pattern.findall(text)

    def alone(self) -> dict[str, int]:
        """The vocabulary's strings that encode alone as one token, and the token."""
        from tokenizers.decoders import ByteLevel

        decode = ByteLevel().decode
        strings = {}
        for entry, number in self.library.get_vocab(with_added_tokens=False).items():
            text = decode([entry])
            if "\ufffd" not in text:
                strings[text] = number
        self.learn(set("".join(strings)))
        texts = [t for t in strings if self.split(t) == [t]]
        coded = self.library.encode_batch(texts, add_special_tokens=False)
        return {t: strings[t] for t, e in zip(texts, coded, strict=True) if e.ids == [strings[t]]}

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Stretches of a text, and whether each is a special string."""
        if self.cut is None or not self.cut.search(text):
            yield text, False
            return
        for k, part in enumerate(self.cut.split(text)):
            if part:
                yield part, bool(k % 2)

    def runs(self, text: str) -> Iterator[str]:
        """A long text in runs that end where a pre-token surely ends: before a single space inside a line."""
        start = 0
        while len(text) - start > RUN:
            at = text.find(" ", start + RUN)
            while 0 <= at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
                at = text.find(" ", at + 1)
            if at < 0 or at >= len(text) - 1:
                break
            yield text[start:at]
            start = at
        yield text[start:]


@functools.lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


class Merges:
    """Byte-pair merges of many pre-tokens at a time: per step, each row merges its leftmost pair of least rank."""

    def __init__(self, library) -> None:
        self.library = library
        model = json.loads(library.to_str())["model"]
        plain = ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        self.widths = WIDTHS if model["type"] == "BPE" and not any(model.get(k) for k in plain) else ()
        if not self.widths:
            return
        vocab = model["vocab"]
        self.base = max(vocab.values()) + 1
        # The characters that stand for bytes: printable ones for themselves, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        name = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte = np.array([vocab[name[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[x] * self.base + vocab[y] for x, y in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[x + y] for x, y in pairs], np.int32)
        self.none = np.int32(len(pairs))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where(right < 0, -1, left.astype(np.int64) * self.base + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def _merged(self, ids: np.ndarray) -> np.ndarray:
        """``ids`` (rows, width; -1 is the end) after all merges."""
        out, left = ids, np.arange(len(ids))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        column = np.arange(ids.shape[1])
        while len(left):
            at = ranks.argmin(axis=1)
            row = np.arange(len(at))
            best = ranks[row, at]
            active = best < self.none
            if not active.all():
                out[left[~active]] = ids[~active]
                ids, ranks, left, at, best = ids[active], ranks[active], left[active], at[active], best[active]
                if not len(left):
                    break
                row = np.arange(len(at))
            after = column[:-1] > at[:, None]
            moved = np.where(after, ids[:, 1:], ids[:, :-1])
            ids = np.concatenate([moved, np.full((len(at), 1), -1, np.int32)], axis=1)
            # Column j from the merge on now holds what stood behind it.
            ids[row, at] = self.made[best]
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = self.none
            inner = at + 1 < ids.shape[1]
            ranks[row[inner], at[inner]] = self._ranks(ids[row[inner], at[inner]], ids[row[inner], at[inner] + 1])
            inner = at > 0
            ranks[row[inner], at[inner] - 1] = self._ranks(ids[row[inner], at[inner] - 1], ids[row[inner], at[inner]])
        return out

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each pre-token, and all ids in order."""
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        count, found, low = np.zeros(len(words), np.int64), [], 0
        for width in self.widths:
            own = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if not len(own):
                continue
            data = np.frombuffer(b"".join([raw[i] for i in own]), np.uint8)
            filled = np.arange(width) < sizes[own][:, None]
            ids = np.full((len(own), width), -1, np.int32)
            ids[filled] = self.byte[data]
            ids = self._merged(ids)
            kept = ids >= 0
            count[own] = kept.sum(axis=1)
            found.append((own, ids[kept]))
        own = np.flatnonzero(sizes > low)
        coded = [e.ids for e in self.library.encode_batch([words[i] for i in own], add_special_tokens=False)]
        count[own] = [len(c) for c in coded]
        found.append((own, np.fromiter(chain.from_iterable(coded), np.int32)))
        out = np.empty(count.sum(), np.int32)
        first = np.cumsum(count) - count
        for own, ids in found:
            out[_places(first[own], count[own])] = ids
        return count, out


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``count`` of them, one stretch after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Numbers(dict):
    """Pre-tokens (and ids, as whole numbers, that stand for themselves) and their numbers; new ones are noted."""

    def __init__(self, known: list) -> None:
        super().__init__(zip(known, range(len(known))))
        self.new: list = []

    def __missing__(self, piece) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Ids of texts; remembers those of pre-tokens."""

    def __init__(self, path: str) -> None:
        self.pre = pre_tokens(path)
        self.merges = Merges(self.pre.library)
        alone = self.pre.alone()
        self.fixed = len(alone)
        self.numbers = Numbers(list(alone))
        self.ids = np.fromiter(alone.values(), np.int32, len(alone))
        self.first, self.count = np.arange(self.fixed), np.ones(self.fixed, np.int64)
        self.used = np.zeros(self.fixed, np.int64)

    def _forget(self) -> None:
        """Keep the shortcuts, and of the others at most half as many as are remembered, those that came most often."""
        names, least = list(self.numbers), 1
        while True:
            least *= 2
            keep = np.flatnonzero((np.arange(len(names)) < self.fixed) | (self.used >= least))
            if len(keep) - self.fixed <= REMEMBERED // 2:
                break
        self.numbers = Numbers([names[i] for i in keep])
        self.ids = self.ids[_places(self.first[keep], self.count[keep])]
        self.count, self.used = self.count[keep], self.used[keep] // least
        self.first = np.cumsum(self.count) - self.count

    def _look_up(self, pieces: list) -> np.ndarray:
        found = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        new = self.numbers.new
        if new:
            own = [i for i, p in enumerate(new) if isinstance(p, int)]
            count, ids = self.merges.encode(["" if isinstance(p, int) else p for p in new])
            if own:  # these stand for themselves
                where = (np.cumsum(count) - count)[own]
                ids = np.insert(ids, where, [new[i] for i in own])
                count[own] = 1
            self.first = np.append(self.first, len(self.ids) + np.cumsum(count) - count)
            self.ids, self.count = np.append(self.ids, ids), np.append(self.count, count)
            self.used = np.append(self.used, np.zeros(len(new), np.int64))
            new.clear()
        self.used += np.bincount(found, minlength=len(self.used))
        return found

    def _numbered(self, texts: list[str | None], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pre-tokens of all texts, and where each text's begin."""
        if len(self.numbers) - self.fixed > REMEMBERED:
            self._forget()
        found, bounds, pieces, done = [], [0], [], 0
        for text in texts:
            for part, special in self.pre.parts(text or ""):
                if special:
                    pieces.append(self.pre.special[part])
                    continue
                for run in self.pre.runs(part):
                    pieces.extend(self.pre.split(run))
                    if len(pieces) > LOOKED_UP:
                        found.append(self._look_up(pieces))
                        done += len(pieces)
                        pieces = []
            if end is not None:
                pieces.append(end)
            bounds.append(done + len(pieces))
        found.append(self._look_up(pieces))
        return np.concatenate(found), np.array(bounds)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        numbers, bounds = self._numbered(texts, None)
        return np.diff(np.concatenate([[0], np.cumsum(self.count[numbers])])[bounds])

    def encode(self, texts: list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each text, with ``end`` behind each if given, and all tokens in order."""
        numbers, bounds = self._numbered(texts, end)
        count = self.count[numbers]
        sizes = np.diff(np.concatenate([[0], np.cumsum(count)])[bounds])
        return sizes, self.ids[_places(self.first[numbers], count)]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row. No shuffle; other columns are not read."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = encoder(path).counts
        for batch in chunks(batches, "text"):
            column = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            found = pa.array(counts(column.to_pylist()))
            yield pa.record_batch([batch.column("doc_id"), sizes, found], ["doc_id", "n_bytes", "n_tokens"])

    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
