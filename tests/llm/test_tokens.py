"""Tokenizing operators against the libraries they stand for."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import tokenizers

from tickloom.llm import bpe_codec, packing, token_transducer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " ",
    "\n\t  x",
    "a",
    "The the THE  two   spaces",
    "déjà vu – ½ ﬁ é ÀΣΑΣ",
    "中文字符測試 日本語 한국어 \U0001f600\U0001f468‍\U0001f469",
    "<|endoftext|>x<|startoftext|> <s></s><unk>",
    "a b c　d \x00\x1c\x85",
    "=" * 999,
    "x" * 5_000,
    "the quick brown fox " * 3_000,
    "ababab" * 700,
    " " * 700 + "t",
    "repeat me",
    "repeat me",
]


def strange(n: int, seed: int = 5) -> list[str]:
    r = random.Random(seed)
    pools = ["ab", "the ", "aeiounrst", "=-*#", "é中字", "01 23", "\n\t \r", "A b\U0001f600▁", "  a", "é ́"]
    return ["".join(r.choice(p) for _ in range(r.choice([1, 3, 10, 70, 300]))) for p in pools for _ in range(n)]


def test_codec_matches_the_library():
    codec = bpe_codec.Codec.load(RANKS, public_tokenizers.PATTERN)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for t in ODD] + strange(20)
    for text, got in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(text), text[:60]
        assert codec.decode(got) == text.encode()


def test_codec_rows_of_one_pair_at_a_time():
    """The merges of one long row equal those of the plain rule, for a vocabulary whose later tokens rank lower."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"aba": 256, b"bab": 257, b"aa": 301, b"aaa": 258, b"abab": 302}
    codec = bpe_codec.Codec(ranks, r"(?s).+")

    def plain(text: bytes) -> list[int]:
        parts = [bytes([b]) for b in text]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    r = random.Random(2)
    for n in (2, 5, 30, 63, 64, 65, 200):
        for _ in range(10):
            text = "".join(r.choice("ab") for _ in range(n))
            assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == plain(text.encode())


def test_codec_operator(spark, docs):
    rows = bpe_codec.round_trip(docs(ODD, [None, *range(1, len(ODD))]), RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) and all(r.lossless for r in rows)
    empty = next(r for r in rows if r.id is None)
    assert (empty.n_tokens, empty.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    ids = {r.id: r.ids for r in bpe_codec.encode_texts(docs(ODD), RANKS, public_tokenizers.PATTERN).collect()}
    assert ids[len(ODD)] == ids[len(ODD) - 1] and len(ids[1]) == 0
    assert bpe_codec.round_trip(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_transducer_matches_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for t in ODD] + strange(30) + ["a" * 30_000, "ab" * 9_000, "xyzzy" * 4_000]
    made = token_transducer.Transducer.load(PIECES)
    assert made.count(texts) == [len(library.encode(t)) for t in texts]


def test_transducer_starts_anew_when_full(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(token_transducer, "STATES", 50)
    made = token_transducer.Transducer.load(PIECES)
    for t in strange(3, seed=8):
        assert made.count([t]) == [len(library.encode(t))]


def test_transducer_operator(docs):
    rows = {r.id: r for r in token_transducer.count_tokens(docs(ODD), PIECES, limit=100).collect()}
    assert (rows[1].n_bytes, rows[1].n_tokens, rows[1].over_limit) == (0, 0, False)
    assert rows[13].over_limit and rows[8].n_bytes == len(ODD[7].encode())
    assert token_transducer.count_tokens(docs([]), PIECES).count() == 0


def test_word_ids_match_the_library():
    library = tokenizers.Tokenizer.from_file(WORDS)
    texts = [t or "" for t in ODD] + strange(20)
    got = packing.WordIds(WORDS).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


def check_packing(texts, rows, window=4096):
    library = tokenizers.Tokenizer.from_file(WORDS)
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts, 1):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.window == pieces[0].window
            at += r.length
        assert at <= pieces[0].window and (pieces[0].window == window or at == pieces[0].window)
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / total, len(sequences)


def test_packing_operator(docs):
    r = random.Random(3)
    texts = [*ODD, *(" ".join(r.choice(["alpha", "beta", "of", "zeta42"]) for _ in range(r.randint(1, 5_000))) for _ in range(60))]
    rows = packing.pack_documents(docs(texts), WORDS, step_size=4).collect()
    wasted, n = check_packing(texts, rows)
    assert wasted < 0.05
    steps = {}
    for row in rows:
        steps.setdefault(row.step_id, set()).add(row.sequence_id)
    assert max(len(s) for s in steps.values()) <= 4 and len(steps) == -(-n // 4)
    assert packing.pack_documents(docs([]), WORDS).count() == 0


def test_packing_fills_windows_and_tiers():
    lengths = [3000, 1000, 96, 2048, 2048, 1024, 1024, 300, 212, 511]
    got = packing.pack_lengths(lengths)
    assert sorted(i for _, pieces in got for i in pieces) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in p) <= w for w, p in got)
    assert got[0] == (4096, [0, 5]) and (2048, [3]) in got
    r = random.Random(1)
    many = [min(4096, int(r.expovariate(1 / 700)) + 1) for _ in range(20_000)]
    got = packing.pack_lengths(many)
    assert sorted(i for _, p in got for i in p) == list(range(len(many)))
    assert sum(w for w, _ in got) < 1.005 * sum(many)


def test_packing_rejects_odd_windows(docs):
    with pytest.raises(ValueError):
        packing.pack_documents(docs(["a"]), WORDS, window=1000)
