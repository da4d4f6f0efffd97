"""Token shards and their perfect hash index against the tokenizers library."""

from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from tickloom.llm import queries
from tickloom.llm.common import table
from tickloom.llm.token_store import ChunkIds, PerfectHash, TokenStore, ask_bucket, make_bucket

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "a  b",
    " lead and trail ",
    "x\n y\t z  w  v",
    "don't WE'LL 'tis it's",
    "été—naïve… ×÷ ª",
    "日本語 テキスト  です",
    "<|endoftext|> a <|endoftext|>b <| endoftext|>",
    "12 3,4.5 %$ a1b2 ...",
    "word," * 3_000,
    "a" * 50_000,
    "\x1c \x85 \x00 x",
    "é ö \U0001f600 \U0001f600‍",
]


def plain_rows(docs, end_id=0):
    """(key, start, n_tokens, crc32) by the library alone, for (key, text) pairs without equal keys of unequal texts."""
    library = tokenizers.Tokenizer.from_file(PATH)
    start, out = 0, []
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_chunks_give_the_ids_of_whole_texts():
    library = tokenizers.Tokenizer.from_file(PATH)
    r = random.Random(3)
    signs = ["a", "B", "é", "1", " ", " ", "\n", ".", "'s", "日", " ", "_", "<|endoftext|>", "\x1f"]
    texts = ODD + ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(3_000)]
    coder = ChunkIds(PATH)
    assert coder.usual and coder.width == 2
    for text, raw in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:50])


@pytest.mark.parametrize("texts", [[], [""], ["a"], ["", "b"], ["\n"], ["a b"], ["a  b", "", "c"], ["\u3000 x", "é É\u00aa ƻ! x\u0301"]])
def test_few_texts(texts):
    library, coder = tokenizers.Tokenizer.from_file(PATH), ChunkIds(PATH)
    for _ in range(2):
        got = [np.frombuffer(raw, "<u2").tolist() for raw in coder.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_is_merged_once_whatever_closes_it(monkeypatch):
    coder, merged, asked = ChunkIds(PATH), [], []
    words, whole = coder.merges.words, coder.whole
    monkeypatch.setattr(coder.merges, "words", lambda w: merged.extend(w) or words(w))
    monkeypatch.setattr(coder, "whole", lambda t: asked.append(t) or whole(t))
    texts = ["go " + " ".join(w + m for w in ("blue", "größe") for m in ("", ",", ".", "...", "?!")) + "\nblue, \nblue", "go  on.\n\nThen blue.\n\nThen"]
    library = tokenizers.Tokenizer.from_file(PATH)
    for _ in range(2):
        for text, raw in zip(texts, coder.encode(texts), strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(w for w in merged if w.strip() in (b"blue", "größe".encode())) == sorted([b" blue", " größe".encode(), b"blue"])
    assert asked.count(" blue.\n\nThen") == 1  # chunks of texts with double spaces are remembered as well


def test_small_memories_give_the_same_ids(monkeypatch):
    monkeypatch.setattr("tickloom.llm.token_store.REMEMBERED", 20)
    library, coder, r = tokenizers.Tokenizer.from_file(PATH), ChunkIds(PATH), random.Random(5)
    for _ in range(60):
        texts = [" ".join("".join(r.choices("abé", k=r.randint(1, 4))) + r.choice(["", ".", "\nx", " ", "7"]) for _ in range(9)) for _ in range(3)]
        for text, raw in zip(texts, coder.encode(texts), strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(coder.known) < 100


@pytest.mark.parametrize("n", [0, 1, 2, 1_000, 50_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(0, 1 << 63, n, np.uint64), rng.integers(0, 1 << 63, n, np.uint64)
    keys = PerfectHash.from_bytes(PerfectHash.build(h1, h2).to_bytes())
    assert sorted(keys.slots(h1, h2)) == list(range(n))
    raw = make_bucket(h1, h2, np.arange(n) % 7, np.arange(n), np.ones(n, int))
    known, slots = ask_bucket(raw, h1, h2)
    assert known.all() and slots["ordinal"].tolist() == list(range(n)) and slots["shard"].tolist() == [i % 7 for i in range(n)]
    strange, _ = ask_bucket(raw, h1 + np.uint64(1), h2 ^ np.uint64(0xF0F0))
    assert strange.sum() == 0


def test_equal_keys_are_told():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], np.uint64), np.array([9, 9], np.uint64))


def test_query_equals_the_library(spark):
    got = sorted(tuple(r) for r in queries.QUERIES["op13_token_store"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    docs = [(d.doc_id, d.text) for d in table(spark, SF, "documents").collect()]
    assert got == sorted(plain_rows(docs))


def test_odd_rows(spark, docs):
    ids = [*range(20, 20 - len(ODD) + 1, -1), None]
    rows = [*zip(ids, ODD, strict=True)] + [(100, None), (-3, "x"), (101, "same text here"), (101, "same text here")] + [(7_000, "hot copy")] * 500
    df = docs([t for _, t in rows], [i for i, _ in rows]).withColumnRenamed("kept", "shard").withColumnRenamed("component_id", "ids")
    store = TokenStore.write(df, PATH, end_id=0, shards=6)
    got = store.read(df)
    assert got.columns == ["id", "start", "n_tokens", "ids_crc32", "ids"]
    got = [tuple(r)[:4] for r in got.collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=order) == plain_rows(rows)
    library = tokenizers.Tokenizer.from_file(PATH)
    assert store.get(20) == [[0]] and store.get(None) == [[*library.encode(ODD[-1]).ids, 0]]
    assert store.get(7_000) == [[*library.encode("hot copy").ids, 0]] * 500
    assert store.get(999) == [] and store.read(spark.createDataFrame([(999,)], "doc_id bigint")).count() == 0
    held = [s for s in store.shards if s[1]]
    assert len(held) > 1 and sum(s[1] for s in held) == len(rows)
    assert max(s[1] for s in held) < 400  # one key of nearly all rows is spread


def test_string_keys_and_empty_table(spark, docs):
    df = spark.createDataFrame([("b", "one two"), ("a", "three"), (None, "four")], "name string, body string")
    store = TokenStore.write(df, PATH, end_id=50256, id_col="name", text_col="body")
    rows = sorted(store.read(df, "name").collect(), key=lambda r: r.start)
    assert [r.id for r in rows] == [None, "a", "b"]
    library = tokenizers.Tokenizer.from_file(PATH)
    assert store.get("a") == [[*library.encode("three").ids, 50256]]
    empty = TokenStore.write(docs([]), PATH)
    assert empty.read(docs(["x"])).count() == 0 and empty.get(1) == [] and not glob.glob(f"{empty.folder}/*.ids")
