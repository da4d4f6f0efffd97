"""Phrase mining against plain counts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import phrases
from tickloom.llm.phrases import HatTrie, Sieve


def plain(rows, longest=3, least=10, share=50, best=2_000):
    out = []
    counts = {}
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]", piece) if w]
            held = counts.setdefault("und" if lang is None else lang, Counter())
            for size in range(1, longest + 1):
                held.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, held in counts.items():
        n = sum(c for p, c in held.items() if len(p) == 1)
        candidates = {p: c for p, c in held.items() if len(p) > 1 and c >= least}
        dropped = set()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                dropped |= {p[i : i + size] for i in range(len(p) - size + 1) if 100 * c >= share * candidates[p[i : i + size]]}
        scored = []
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p)))
            if p not in dropped:
                scored.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "é", "É", "x\x00y", "a\xa0b", "‍", "zz", *[f"w{i}" for i in range(60)]]
    made = []
    for _ in range(n):
        parts = [r.choice(words[: r.choice([5, 12, 70])]) + r.choice(["", "", "", ",", ".", "\n", "\r\n", "!?"]) for _ in range(r.randint(0, 60))]
        made.append((r.choice(["en", "en", "en", None, "und", ""]), r.choice([" ", "  ", "\t"]).join(parts)))
    return [*made, ("en", None), ("de", ""), ("de", " \t\n"), ("en", "new york city " * 3_000)]


def mined(spark, data, **how):
    df = spark.createDataFrame([(i, *x, 1, "z") for i, x in enumerate(data)], "doc_id int, lang string, text string, phrase int, n string")
    got = phrases.collocations(df, **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for c, t in got.dtypes if c not in ("lang", "phrase")] == ["bigint"] * 6
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("how", [{}, {"longest": 4, "least": 3, "share": 80, "best": 20}, {"longest": 2, "least": 1, "best": None}])
def test_equals_plain_counts(spark, how):
    data = rows(len(how), 300)
    want = plain(data, **(how | ({"best": 10**9} if "best" in how and how["best"] is None else {})))
    assert mined(spark, data, **how) == want and len(want) > 20


def test_empty_table_and_wrong_bounds(spark):
    assert mined(spark, []) == []
    with pytest.raises(ValueError):
        mined(spark, [], longest=1)


@pytest.mark.parametrize("words", [1, 2, 3])
def test_trie_bursts_and_spills_whole_subtrees(words):
    r = random.Random(words)
    trie, want, got = HatTrie(words, burst=8), Counter(), Counter()
    spilled = 0
    for _ in range(60):
        batch = Counter(sum(r.randint(1, 30) << 32 * i for i in range(words)) for _ in range(200))
        trie.add(list(batch), list(batch.values()))
        want.update(batch)
        assert trie.held == trie._size(trie.root)
        if trie.held > 100:
            left = set(trie.root) if words > 1 else set()
            run, counts = trie.spill(50)
            got.update(dict(zip(run, counts, strict=True)))
            spilled += 1
            # what is taken out starts with other words than what stays
            assert words == 1 or {p >> 32 * (words - 1) for p in run} == left - set(trie.root)
            assert trie.held <= 50
    run, counts = trie.spill()
    got.update(dict(zip(run, counts, strict=True)))
    assert got == want and trie.held == 0 and (spilled or words == 1)


def test_sieve_lets_every_frequent_phrase_through():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5_000, np.uint64)
    bits = 1 << 18
    box = np.zeros(bits // 8, np.uint8)
    for at in Sieve.places(hashes, bits):
        np.bitwise_or.at(box, at >> 3, (1 << (at & 7)).astype(np.uint8))
    sieve = Sieve(bits, {0: box.tobytes()})
    assert sieve.has(hashes).all() and sieve.has(rng.integers(0, 1 << 63, 5_000, np.uint64)).mean() < 0.05
