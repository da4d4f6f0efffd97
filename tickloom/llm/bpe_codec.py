"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are split by the tokenizer's pattern; every distinct piece of a step is encoded once. Pieces are bucketed by
length into padded matrices of token ids. In each round every row merges its leftmost pair of least rank, the matrix
loses one column, and rows without a pair leave it. Pairs are looked up in a hash table held in numpy arrays.

A piece longer than ``WIDE`` bytes is cut where no token holds the two bytes side by side, then merged as one row: all
occurrences of the least pair in one round, as long as no pair that this makes ranks lower (otherwise the leftmost only),
which gives the same ids with far fewer rounds.

Null text counts as empty: no ids, and the digests of no bytes. Ids and repeated rows pass through unchanged.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import map_texts
from tickloom.llm.intmap import ABSENT, IntMap

NONE = np.int32(2**31 - 1)
#: Longest piece, in bytes, that goes into a matrix.
WIDE = 64
#: Pieces remembered by a worker; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Cells of one matrix.
CELLS = 4_000_000


class PairTable:
    """(left id, right id) to the id of their concatenation."""

    def __init__(self, left: list[int], right: list[int], whole: list[int], vocab: int):
        self.vocab, self.map = vocab, IntMap(2 * len(whole))
        self.map.add(np.array(left, np.int64) * vocab + np.array(right, np.int64), np.array(whole, np.int64))

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merged pairs; ``NONE`` where there is none or a side is negative (padding)."""
        out = self.map.get(np.maximum(left.astype(np.int64), 0) * self.vocab + np.maximum(right, 0))
        return np.where((out == ABSENT) | (left < 0) | (right < 0), NONE, out).astype(np.int32)


class Codec:
    """Ranks of a vocabulary file with one ``base64 rank`` line per token; ranks are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, whole = [], [], []
        beside = np.zeros((256, 256), bool)
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
            for i in range(1, len(token)):
                beside[token[i - 1], token[i]] = True
                a = ranks.get(token[:i])
                if a is not None and (b := ranks.get(token[i:])) is not None:
                    left.append(a)
                    right.append(b)
                    whole.append(rank)
        self.beside = beside
        self.pairs = PairTable(left, right, whole, size)
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.known: dict[str, bytes] = {}

    @staticmethod
    @lru_cache(4)
    def load(path: str, pattern: str) -> Codec:
        with open(path, "rb") as f:
            return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list({p for pieces in split for p in pieces if p not in self.known})
        self.known.update(zip(fresh, self._pieces([p.encode() for p in fresh]), strict=True))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        x = np.frombuffer(ids, "<u4")
        size = self.length[x]
        ends = np.cumsum(size)
        at = np.repeat(self.start[x] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at].tobytes()

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        out = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        edge = 0
        for width in (1, 4, 6, 8, 10, 12, 16, 24, 32, 48, WIDE):
            of = np.flatnonzero((sizes > edge) & (sizes <= width))
            edge = width
            for part in np.array_split(of, max(1, len(of) * width // CELLS)):
                if len(part):
                    self._matrix(part, pieces, sizes[part], width, out)
        for i in np.flatnonzero(sizes > WIDE):
            raw = np.frombuffer(pieces[i], np.uint8)
            cuts = np.flatnonzero(~self.beside[raw[:-1], raw[1:]]) + 1
            out[i] = b"".join(self._row(self.single[x]).astype("<u4").tobytes() for x in np.split(raw, cuts))
        return out

    def _matrix(self, of: np.ndarray, pieces: list[bytes], sizes: np.ndarray, width: int, out: list[bytes]) -> None:
        ids = np.full((len(of), width), -1, np.int32)
        raw = np.frombuffer(b"".join(pieces[i] for i in of), np.uint8)
        ids[np.arange(width) < sizes[:, None]] = self.single[raw]
        rank = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(of), width - 1)
        while len(of):
            if not ids.shape[1] > 1:
                done, at = np.ones(len(of), bool), None
            else:
                at = rank.argmin(axis=1)
                least = rank[np.arange(len(of)), at]
                done = least == NONE
            if done.any():
                left = ids[done]
                n = (left >= 0).sum(axis=1)
                flat, ends = left[left >= 0].astype("<u4").tobytes(), np.cumsum(n) * 4
                for i, a, b in zip(of[done].tolist(), (ends - n * 4).tolist(), ends.tolist(), strict=True):
                    out[i] = flat[a:b]
                stay = ~done
                of, ids = of[stay], ids[stay]
                if not len(of):
                    return
                rank, at, least = rank[stay], at[stay], least[stay]
            row = np.arange(len(of))
            cols = np.arange(ids.shape[1] - 1)
            ids[row, at] = least
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            rank = np.take_along_axis(rank, cols[:-1] + (cols[:-1] > at[:, None]), axis=1)
            before = at > 0
            rank[row[before], at[before] - 1] = self.pairs.get(ids[row[before], at[before] - 1], least[before])
            after = at < rank.shape[1]
            rank[row[after], at[after]] = self.pairs.get(least[after], ids[row[after], at[after] + 1])

    def _row(self, ids: np.ndarray) -> np.ndarray:
        rank = self.pairs.get(ids[:-1], ids[1:])
        while len(rank) and (least := rank.min()) != NONE:
            at = np.flatnonzero(rank == least)
            run = np.cumsum(np.concatenate([[True], np.diff(at) > 1]))  # overlapping pairs: every other one
            first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
            at = at[(np.arange(len(at)) - first[run - 1]) % 2 == 0]
            if len(at) > 1:
                merged, new_rank = self._merged(ids, rank, at, least)
                touching = at[:-1][np.diff(at) == 2]
                half = len(touching) and self.pairs.get(np.array([least]), ids[touching[:1] + 2])[0] < least
                if not half and not (new_rank < least).any():
                    ids, rank = merged, new_rank
                    continue
            ids, rank = self._merged(ids, rank, at[:1], least)
        return ids

    def _merged(self, ids: np.ndarray, rank: np.ndarray, at: np.ndarray, token: int) -> tuple[np.ndarray, np.ndarray]:
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        ids = ids.copy()
        ids[at] = token
        ids = ids[stay]
        now = at - np.arange(len(at))  # places of the merged tokens
        rank = rank[stay[1:]]
        near = np.unique(np.concatenate([now - 1, now]))
        near = near[(near >= 0) & (near < len(ids) - 1)]
        rank[near] = self.pairs.get(ids[near], ids[near + 1])
        return ids, rank


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array of int): every whole text as token ids."""

    def work(ids, texts):
        got = Codec.load(path, pattern).encode(texts)
        return {"id": ids, "ids": [np.frombuffer(x, "<u4").astype(np.int32) for x in got]}

    return map_texts(df, id_col, text_col, "id bigint, ids array<int>", work)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, lossless): encode every whole text, decode its ids, compare."""

    def work(ids, texts):
        codec = Codec.load(path, pattern)
        coded = codec.encode(texts)
        digests = [hashlib.sha256(codec.decode(x)).hexdigest() for x in coded]
        return {
            "id": ids,
            "n_tokens": [len(x) // 4 for x in coded],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in coded],
            "decoded_sha256": digests,
            "lossless": [hashlib.sha256(t.encode()).hexdigest() == d for t, d in zip(texts, digests, strict=True)],
        }

    schema = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, lossless boolean"
    return map_texts(df, id_col, text_col, schema, work)
