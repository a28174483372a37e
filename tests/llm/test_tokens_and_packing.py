import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_librarys(docs, library):
    found = tokens.count_tokens(docs, PATH).collect()
    wanted = [(r["doc_id"], len((r["text"] or "").encode()), len(ids(library, r["text"]))) for r in docs.collect()]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def coded(texts, one=None, end=None):
    sizes, found = (one or tokens.encoder(PATH)).encode(texts, end)
    assert one is not None or (sizes - (end is not None)).tolist() == tokens.encoder(PATH).counts(texts).tolist()
    return [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])]


def test_random_texts_encode_as_the_library_does(library):
    random.seed(3)
    letters = [chr(c) for c in (*range(1, 0x250), *range(0x2000, 0x2070), 0x4E2D, 0x1F600)] + ["<|endoftext|>"]
    texts = ["".join(random.choices(letters + list(" etaoin'" * 40), k=random.randint(0, 120))) for _ in range(800)]
    texts += ["a" * 70, " " * 40, "it's we'll I'm 'tis", "\n\n x\t\ty "]
    assert coded(texts) == [ids(library, t) for t in texts]
    assert coded(["ab", None, ""], end=7) == [ids(library, "ab") + [7], [7], [7]]


def test_texts_of_all_scripts_encode_as_the_library_does(library):
    """Code points of every plane, assigned or not, among letters, numbers, spaces and signs."""
    rng = random.Random(8)
    blocks = [0x370, 0x400, 0x590, 0x600, 0x900, 0xE00, 0x1100, 0x1680, 0x1E00, 0x20A0, 0x2150, 0x2400, 0x3000, 0x4E00, 0xAC00, 0xE000,
              0xFE00, 0xFF00, 0x10000, 0x1D400, 0x1F300, 0x20000, 0xE0000, 0x10FF00]
    texts = []
    for block in blocks:
        own = [chr(c) for c in range(block, block + 256)]
        texts += ["".join(rng.choices(own + list("ab1 #'\n") * 8, k=rng.randint(1, 80))) for _ in range(40)]
        texts += ["".join(own)]
    texts += ["Привет, мир! 5 € – 日本語のテキスト 😀😀 ok", "a\u3000b\u00a0 c\u2003\u2003d", "x\u0085y\x1cz"]
    assert coded(texts) == [ids(library, t) for t in texts]
    assert len(tokens.pre_tokens(PATH).alone()) > 40_000


def test_long_texts_are_cut_where_a_pre_token_ends(library, monkeypatch):
    monkeypatch.setattr(tokens, "RUN", 50)
    text = "some words  with   gaps\n and 'quotes we'll see 12 34, " * 20
    assert coded([text]) == [ids(library, text)]
    monkeypatch.setattr(tokens, "LOOKED_UP", 3)
    assert coded([text, "", text + "é", None]) == [ids(library, t) for t in (text, "", text + "é", "")]


def test_a_full_cache_keeps_what_came_often(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    texts = [f"unlikelyish wordings zq{i}x {'qqzzj' * 3} <|endoftext|>" + f" yyk{i}" * (i % 3) for i in range(30)]
    one = tokens.Encoder(PATH)
    for t in texts + texts:
        assert coded([t], one, 3) == [ids(library, t) + [3]]
    assert len(one.numbers) - one.fixed < 30 and " " + "qqzzj" * 3 in one.numbers


def test_single_tokens_encode_alone(library):
    alone = tokens.pre_tokens(PATH).alone()
    assert len(alone) > 40_000
    for text in random.Random(1).sample(sorted(alone), 200):
        assert ids(library, text) == [alone[text]]


def test_packing_is_gapless_and_whole(docs, library):
    pieces = packing.pack(docs, PATH, length=64).collect()
    whole = {}
    for r in docs.collect():
        whole.setdefault(r["doc_id"], []).append(ids(library, r["text"]) + [0])
    for p in pieces:
        cut = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(cut) == p["length"]
        assert any(w[p["start"] : p["start"] + p["length"]] == cut and len(w) == p["doc_tokens"] for w in whole[p["doc_id"]])
    assert sum(p["length"] for p in pieces) == sum(len(w) for ws in whole.values() for w in ws)
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == sequences.get(p["sequence_id"], 0)
        sequences[p["sequence_id"]] = p["offset"] + p["length"]
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(n == 64 for s, n in sequences.items() if s < len(sequences) - 1)


def test_empty_tables(none):
    assert tokens.count_tokens(none, PATH).count() == 0
    assert packing.pack(none, PATH).count() == 0


def test_crc_of_ids():
    assert zlib.crc32(np.array([5, 70000], "<u4").tobytes()) == zlib.crc32(b"\x05\x00\x00\x00\x70\x11\x01\x00")
