"""Packing documents into token sequences of several lengths.

A document's ids are cut at multiples of the longest window; full windows are sequences of their own. The rest of each
document is a piece that is routed to the shortest tier (a power of two up to the window) that holds it. Pieces are
dealt by number into shards of bounded size, and every shard is packed in turn:

1. each piece of the longest tier opens a window; gaps are filled, largest piece first, from the shorter tiers, always
   into the smallest gap that holds the piece;
2. what is left of each shorter tier is packed into windows of its own length, and those that come out exactly full stay
   sequences of that length;
3. the pieces of windows that did not come out full go into long windows, again by best fit.

Sequences are dealt to step groups of ``step_size`` by falling cost (the sum of squared piece lengths) and in turning
order, so that groups of a shard carry about the same load.

Ids never leave the task that made them; the table of pieces (numbers only) is written to the shared folder, so its numbering
holds however often later tasks run. A word is encoded once per worker and remembered; the vocabulary drops white space
and never joins words over it, so the ids are those of the whole text.

Null text counts as empty: a document of one id, the end mark. Repeated rows are documents of their own, also under one id.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_schema, batch_of, steps, stored, text_of

#: Words remembered by a worker in each of two generations: a full one replaces the former, and words seen again move on.
REMEMBERED = 300_000
#: Lower-case words without marks that combine: NFC leaves them as they are.
LATIN = re.compile("[!-~\u00a1-\u024f]+")
#: Most pieces of a shard, on average.
SHARD = 40_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, piece_no bigint"
PLACED = f"{PIECES}, sequence_id bigint, offset bigint, window bigint, step_id bigint"


class WordIds:
    """Ids of whole texts by a tokenizer that drops white space and keeps words apart.

    New words go through the library's whole chain, or, where the chain is the usual one (NFC, lower case, a split
    pattern, bytes as printable signs) and the word has Latin letters and signs only, straight to its BPE model: the
    rest of the chain is plain for those, and calling it for one word costs several times the merges.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads for short words only add to its time
        self.library = tokenizers.Tokenizer.from_file(path)
        self.model = self.library.model
        self.known: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}
        with open(path) as f:
            chain = json.load(f)
        self.split = self._split_pattern(chain)
        special = [re.escape(t["content"].lower()) for t in chain["added_tokens"]]
        self.special = re.compile("|".join(special) or "(?!)")
        # the printable sign of each byte, as byte-level tokenizers have it
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        shifted = iter(range(0x100, 0x200))
        self.signs = {b: b if b in plain else next(shifted) for b in range(256)}

    @staticmethod
    def _split_pattern(chain: dict):
        usual = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
        steps = (chain.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if (chain.get("normalizer") or {}).get("normalizers") != usual or len(steps) != 2:
            return None
        head, tail = steps
        if (head.get("type"), head.get("behavior"), head.get("invert")) != ("Split", "Removed", True):
            return None
        if (tail.get("type"), tail.get("add_prefix_space"), tail.get("use_regex")) != ("ByteLevel", False, False):
            return None
        return regex.compile(head["pattern"]["Regex"])

    @staticmethod
    @lru_cache(2)
    def load(path: str) -> WordIds:
        return WordIds(path)

    def _latin(self, word: str) -> list[int]:
        ids = []
        for part in self.split.findall(word):
            ids += [t.id for t in self.model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(self.signs))]
        return ids

    def _new(self, words: list[bytes]) -> list[list[int]]:
        texts = [w.decode() for w in words]
        low = [t.lower() for t in texts]
        plain = [self.split is not None and LATIN.fullmatch(t) is not None and not self.special.search(t) for t in low]
        rest = [t for t, p in zip(texts, plain, strict=True) if not p]
        whole = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [self._latin(t) if p else next(whole).ids for t, p in zip(low, plain, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [t.encode().split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.former = {}, self.known
        unseen = set().union(*split).difference(self.known)
        again = unseen.intersection(self.former)
        self.known.update((w, self.former[w]) for w in again)
        fresh = list(unseen - again)
        for i in range(0, len(fresh), 20_000):
            part = fresh[i : i + 20_000]
            self.known.update(zip(part, [struct.pack(f"<{len(x)}I", *x) for x in self._new(part)], strict=True))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def cut_documents(df: DataFrame, path: str, end_id: int, window: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: full windows, then the rest. ``piece_no`` tells pieces apart within one run of the tasks."""
    kind = arrow_schema(PIECES)
    mark = np.array([end_id], "<u4").tobytes()

    def run(batches):
        words, number = WordIds.load(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in steps(texts):
                rows = []
                for doc, coded in zip(ids[a:b], words.encode(texts[a:b]), strict=True):
                    coded += mark
                    total = len(coded) // 4
                    for start in range(0, total, window):
                        held = memoryview(coded)[4 * start : 4 * (start + window)]
                        rows.append((doc, start, len(held) // 4, zlib.crc32(held), total, number))
                        number += 1
                yield batch_of(rows, kind)

    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, PIECES)


class Gaps:
    """Open windows by what is free in them; the smallest gap that fits is found in a bit mask."""

    def __init__(self, window: int):
        self.window, self.mask, self.by_gap = window, 0, {}
        self.held: list[list[int]] = []

    def put(self, at: int, gap: int) -> None:
        if gap:
            self.by_gap.setdefault(gap, []).append(at)
            self.mask |= 1 << gap

    def open(self, piece: int, length: int) -> None:
        self.held.append([piece])
        self.put(len(self.held) - 1, self.window - length)

    def fit(self, piece: int, length: int) -> bool:
        above = self.mask >> length
        if not above:
            return False
        gap = length + (above & -above).bit_length() - 1
        at = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            self.mask ^= 1 << gap
        self.held[at].append(piece)
        self.put(at, gap - length)
        return True


def pack_lengths(lengths: list[int], window: int = 4096, shortest: int = 512) -> list[tuple[int, list[int]]]:
    """(window length, pieces by number) of every sequence, for pieces of at most ``window`` ids."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    long, rest = Gaps(window), []
    for i in order:
        if lengths[i] > window // 2:
            long.open(i, lengths[i])
        elif not long.fit(i, lengths[i]):
            rest.append(i)
    full: list[tuple[int, list[int]]] = []
    waiting: list[int] = []
    tier = window // 2
    while tier >= shortest:
        gaps, below = Gaps(tier), []
        for i in rest:
            if not gaps.fit(i, lengths[i]):
                if lengths[i] > tier // 2 or tier == shortest:
                    gaps.open(i, lengths[i])
                else:
                    below.append(i)
        for pieces in gaps.held:
            if sum(lengths[i] for i in pieces) == tier:
                full.append((tier, pieces))
            else:
                for i in pieces:
                    (waiting if lengths[i] > tier // 2 else below).append(i)
        rest = sorted(below, key=lambda i: (-lengths[i], i))
        tier //= 2
    for i in sorted(waiting + rest, key=lambda i: (-lengths[i], i)):
        if not long.fit(i, lengths[i]):
            long.open(i, lengths[i])
    return [(window, pieces) for pieces in long.held] + full


def _pack(shard: pd.DataFrame, window: int, shortest: int, step_size: int) -> pd.DataFrame:
    shard = shard.sort_values("piece_no", ignore_index=True)
    lengths = shard["length"].tolist()
    number, sequences = int(shard["shard"].iloc[0]) << 32, pack_lengths(lengths, window, shortest)
    cost = [sum(lengths[i] ** 2 for i in pieces) for _, pieces in sequences]
    groups = -(-len(sequences) // step_size)
    sequence, offset = np.empty(len(shard), np.int64), np.empty(len(shard), np.int64)
    windows, step = np.empty(len(shard), np.int64), np.empty(len(shard), np.int64)
    for place, q in enumerate(sorted(range(len(sequences)), key=lambda q: (-cost[q], q))):
        lap, seat = divmod(place, groups)
        size, pieces = sequences[q]
        at = 0
        for i in pieces:
            sequence[i], offset[i], windows[i] = number + q, at, size
            step[i] = number + (seat if lap % 2 == 0 else groups - 1 - seat)
            at += lengths[i]
    return shard.drop(columns="shard").assign(sequence_id=sequence, offset=offset, window=windows, step_id=step)


def pack_documents(
    df: DataFrame,
    path: str,
    end_id: int = 2,
    window: int = 4096,
    shortest: int = 512,
    step_size: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece with its place: (doc_id, start, length, ids_crc32, doc_tokens, piece_no, sequence_id, offset,
    window, step_id)."""
    if window & (window - 1) or shortest & (shortest - 1) or not 1 < shortest < window:
        raise ValueError("window and shortest are powers of two, shortest the smaller")
    pieces, _ = stored(cut_documents(df, path, end_id, window, id_col, text_col), "pieces")
    shards = -(-pieces.count() // SHARD)
    # numbers of one task lie close together, so a hash deals them evenly whatever the documents are
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("piece_no"), F.lit(max(1, shards))))
    return dealt.groupBy("shard").applyInPandas(lambda shard: _pack(shard, window, shortest, step_size), PLACED)
