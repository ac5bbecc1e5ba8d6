"""Token files: round trips of the code, ids against the tokenizer, files read back."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketlake.llm import tokenfile
from marketlake.llm.tokenfile import BLOCK, COUNTS, ESCAPE, WIDTHS, Encoder, decode, encode

PATH = public_tokenizers.path(tokenfile.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_the_code_fills_sixty_bits():
    assert len(COUNTS) == len(WIDTHS) == 16
    assert all(n * w <= 60 for n, w in zip(COUNTS, WIDTHS))


@settings(max_examples=60, deadline=None)
@over(st.lists(st.tuples(st.integers(0, 64), st.integers(1, 400)), max_size=12), st.integers(0, 10**6))
def test_round_trip(runs, seed):
    draw = np.random.default_rng(seed)
    parts = [draw.integers(0, 1 << bits, n, dtype=np.uint64) if bits < 64 else draw.integers(0, (1 << 64) - 1, n, dtype=np.uint64, endpoint=True) for bits, n in runs]
    ids = np.concatenate([np.zeros(0, dtype=np.uint64), *parts])
    image = encode(ids, block=256)
    assert (decode(image) == ids).all() and len(decode(image)) == len(ids)
    if len(ids):
        low, high = sorted(int(x) for x in draw.integers(0, len(ids) + 1, 2))
        assert decode(image, low, high).tolist() == ids[low:high].tolist()


@pytest.mark.parametrize("ids", [[], [0], [ESCAPE - 1, ESCAPE, ESCAPE + 1, (1 << 64) - 1], [0] * (BLOCK + 1), [1] * (3 * BLOCK), list(range(5000))])
def test_edges_of_the_code(ids):
    assert decode(encode(np.array(ids, dtype=np.uint64))).tolist() == ids


def test_words_are_packed_greedily():
    ids = np.array([0] * 240 + [3] * 30 + [70000] * 3 + [1 << 40], dtype=np.uint64)
    words = np.frombuffer(encode(ids), dtype="<u8", offset=tokenfile.HEADER.size)[4:]
    assert [int(w) >> 60 for w in words] == [0, 3, 13, 14, 15][: len(words)] or [int(w) >> 60 for w in words][:3] == [0, 3, 13]
    # Ids of a vocabulary of 49 thousand: three or more a word.
    draw = np.random.default_rng(0).integers(0, 49408, 100_000).astype(np.uint64)
    assert len(encode(draw)) < 2.8 * len(draw)


ODD = [
    " " * 1_000_000 + "x", " " * 50_000 + "x", "a" * 100_000, "　x y\x1c\x1dz\x85q", "é ́a ́x", "ΑΣ ΣΑΣ İI ß ﬁ", "<|endoftext|> a<|endoftext|>b < |endoftext|>",
    "it's  'S don't'll we'Ve", "\x00 \x00a", "a‍b \U0001f600\U0001f468‍\U0001f469 日本語 한국어 が", "1234 12.5e-3 !!??..", "",
]


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_ids_are_the_tokenizers(tokenizer, text):
    assert np.frombuffer(Encoder(PATH)(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@over(st.text(max_size=60))
def test_ids_of_any_text(tokenizer, text):
    assert np.frombuffer(_SHARED(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


_SHARED = Encoder(PATH)


def plain(tokenizer, rows):
    """Rows in their order → doc_id, start, n_tokens, crc32."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_by_the_tokenizer(run, given, tokenizer):
    got = run("op12_token_files").sort_values("doc_id")
    expected = plain(tokenizer, zip(given["doc_id"], given["text"]))
    assert list(got[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == expected


def test_odd_rows_and_a_stretch_of_the_stream(spark, odd, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "SEGMENT", 500)  # several segments a shard
    path = str(tmp_path / "tokens")
    tokenfile.write(odd.repartition(4), path)
    found = tokenfile.read(spark, path).collect()
    rows = sorted((r for r in found), key=lambda r: r["start"])
    assert [r["doc_id"] is None for r in rows[:2]] == [True, True]
    ids_of = [r["doc_id"] for r in rows[2:]]
    assert ids_of == sorted(ids_of)
    # Equal ids come in an order of their texts: compare as multisets, and places as a chain.
    at = 0
    for r in rows:
        assert r["start"] == at and zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    expected = [(d, n, c) for d, _, n, c in plain(tokenizer, [(r["doc_id"], r["text"]) for r in odd.collect()])]
    assert sorted(map(repr, ((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows))) == sorted(map(repr, expected))
    stream = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    for start, n in ((0, 10), (17, 4000), (at - 5, 100), (at, 3)):
        assert tokenfile.tokens(spark, path, start, n).tolist() == stream[start : start + n].tolist()


def test_no_documents(no_docs):
    assert tokenfile.encoded(no_docs).collect() == []
