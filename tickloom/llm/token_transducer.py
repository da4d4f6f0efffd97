"""Token counts by a finite-state transducer compiled from a piece vocabulary.

The library merges the best-scored adjacent pieces of a text until none is left. For every prefix of a text the last
token of its encoding is fixed by the tokens that end before it: it is the one piece that ends there and whose pair with
the token before it is itself stable under merging. So a state needs, for every suffix of the text read that can still grow into a piece,
the token that ends before that suffix and how many tokens the suffix holds now. A transition reads one character and is annotated with the change of the
token count. States are numbered as texts reach them, transitions are kept in a hash map, and both
are dropped when they outgrow ``STATES``; the counts do not depend on that.

Texts are cut into chunks. Where no piece holds the two characters around a cut, the chunk starts in the start state.
Inside a longer run the entry state is not known, so each chunk has a map from entry states to (exit state, count), first
for the state that a short look back suggests. Maps are composed by a parallel prefix scan (pointer doubling), and maps
that lack the state that really enters are extended until every run is closed, so the count is exact for any text. All
chunks of a step advance together, one character at a time, in numpy.

Null text counts as empty (0 bytes, 0 tokens). Control strings inside texts are ordinary text, as is the library's
default. Ids and repeated rows pass through unchanged.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from tickloom.llm.common import map_texts
from tickloom.llm.intmap import ABSENT, IntMap

SPACE = "▁"
START = 0
#: Token that stands for "nothing to merge with on the left".
EDGE = -1
CHUNK = 192
LOOK_BACK = 32
STATES = 600_000
#: Chunks to which a run that stays open gives its state at once.
AHEAD = 256
OFFSET = 64


class Transducer:
    def __init__(self, pieces: dict[str, float]):
        self.score = pieces
        self.chars = sorted({c for p in pieces for c in p})
        self.n_known = len(self.chars)
        # classes 0..n-1 are characters of the vocabulary, then unknown ones of 1 to 4 bytes
        self.n_class = self.n_known + 4
        code = np.arange(0x110000)
        self.class_of = (self.n_known + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)).astype(np.int32)
        for k, c in enumerate(self.chars):
            self.class_of[ord(c)] = k
        self.class_of[0x20] = self.class_of[ord(SPACE)]
        self.text: list[str] = []
        self.child: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [EDGE]
        #: Class pairs that stand side by side in a piece; texts can be cut anywhere else.
        self.beside = np.zeros((self.n_class, self.n_class), bool)
        for p in pieces:
            node = 0
            classes = [int(self.class_of[ord(c)]) for c in p]
            for k in classes:
                if k not in self.child[node]:
                    self.child[node][k] = len(self.child)
                    self.child.append({})
                    self.token_at.append(EDGE)
                node = self.child[node][k]
            self.token_at[node] = len(self.text)
            self.text.append(p)
            for a, b in zip(classes, classes[1:], strict=False):
                self.beside[a, b] = True
        self.stable: dict[tuple[int, int], bool] = {}
        self._reset()

    @staticmethod
    @lru_cache(4)
    def load(path: str) -> Transducer:
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        skip = (lib.is_control, lib.is_unknown, lib.is_byte, lib.is_unused)
        made = Transducer({lib.id_to_piece(i): lib.get_score(i) for i in range(len(lib)) if not any(f(i) for f in skip)})
        for probe in ("", " ", "  Two  words\n", "é ½ ﬁ", "<s>x</s> 12,345", "\U0001f600中"):
            if made.count([probe])[0] != len(lib.encode(probe)):
                raise ValueError(f"{path} normalises texts or is no BPE model with byte fallback")
        return made

    def _reset(self) -> None:
        # a state: ((trie node of a live suffix, token before the suffix, tokens the suffix holds), ...), the root first
        self.states: list[tuple] = [((0, EDGE, 0),)]
        self.number = {self.states[0]: START}
        self.moves = IntMap(1 << 16)

    def _merge(self, text: str) -> list[str]:
        """The library's merges, for the short texts of pairs."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best[0]):
                    best = s, i
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _is_stable(self, a: int, b: int) -> bool:
        """Whether token ``b`` stays whole after token ``a`` (or alone)."""
        got = self.stable.get((a, b))
        if got is None:
            pair = [self.text[x] for x in (a, b) if x != EDGE]
            if len(self.stable) > 2 * STATES:
                self.stable = {}
            got = self.stable[a, b] = self._merge("".join(pair)) == pair
        return got

    def _step(self, state: int, k: int) -> int:
        """Packed (next state, change of the count) of one transition."""
        if k >= self.n_known:
            return START << 8 | (k - self.n_known + 1 + OFFSET)
        live = self.states[state]
        last = live[0][1]
        if last != EDGE and not self.beside[self.class_of[ord(self.text[last][-1])], k]:
            live = self.states[START]
        for node, before, held in reversed(live):
            grown = self.child[node].get(k)
            token = EDGE if grown is None else self.token_at[grown]
            if token != EDGE and self._is_stable(EDGE, token) and (before == EDGE or self._is_stable(before, token)):
                change = 1 - held
                break
        else:
            raise AssertionError("a character of the vocabulary is always a token")
        nxt = [(0, token, 0)]
        for node, before, held in live:
            grown = self.child[node].get(k)
            if grown is not None and self.child[grown]:
                nxt.append((grown, before, held + change))
        made = self.number.setdefault(tuple(nxt), len(self.states))
        if made == len(self.states):
            self.states.append(tuple(nxt))
        return made << 8 | (change + OFFSET)

    def _move(self, states: np.ndarray, classes: np.ndarray) -> np.ndarray:
        keys = states * self.n_class + classes
        got = self.moves.get(keys)
        if (got == ABSENT).any():
            fresh = np.unique(keys[got == ABSENT])
            made = [self._step(*divmod(x, self.n_class)) for x in fresh.tolist()]
            self.moves.add(fresh, np.array(made, np.int64))
            got = self.moves.get(keys)
        return got

    def run(self, classes: np.ndarray, begin: np.ndarray, end: np.ndarray, entry: np.ndarray):
        """Exit states and counts of the spans, read from their entry states, all in step."""
        order = np.argsort(begin - end, kind="stable")
        begin, size = begin[order], (end - begin)[order]
        state, count = entry[order].astype(np.int64), np.zeros(len(order), np.int64)
        n = len(order)
        for i in range(int(size[0]) if n else 0):
            while size[n - 1] <= i:
                n -= 1
            got = self._move(state[:n], classes[begin[:n] + i])
            state[:n] = got >> 8
            count[:n] += (got & 255) - OFFSET
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def count(self, texts: list[str]) -> list[int]:
        if len(self.states) > STATES:
            self._reset()
        marked = [SPACE + t if t else "" for t in texts]
        sizes = np.array([len(t) for t in marked], np.int64)
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4")
        if not len(codes):
            return [0] * len(texts)
        classes = self.class_of[codes].astype(np.int64)
        free = np.ones(len(codes), bool)
        free[1:] = ~self.beside[classes[:-1], classes[1:]]
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        free[starts] = True
        begin = self._cuts(np.flatnonzero(free), starts, len(codes))
        end = np.append(begin[1:], len(codes))
        total = self._scan(classes, begin, end, free[begin])
        doc = np.repeat(np.arange(len(texts)), sizes)[begin]
        return np.bincount(doc, weights=total, minlength=len(texts)).astype(np.int64).tolist()

    @staticmethod
    def _cuts(free: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """Begins of chunks: each text, the first free place of each window, and every window inside longer runs."""
        first = free[np.unique(free // CHUNK, return_index=True)[1]]
        gaps = np.diff(np.append(free, size))
        inner = [np.arange(a + CHUNK, a + g, CHUNK) for a, g in zip(free[gaps > CHUNK], gaps[gaps > CHUNK], strict=True)]
        return np.unique(np.concatenate([first, starts, *inner]))

    def _scan(self, classes, begin, end, free) -> np.ndarray:
        """Counts of the runs of chunks, at the first chunk of each run; 0 elsewhere."""
        n = len(begin)
        entry = np.full(n, START, np.int64)
        guess = np.flatnonzero(~free)
        if len(guess):
            entry[guess], _ = self.run(classes, begin[guess] - LOOK_BACK, begin[guess], entry[guess])
        chunk = np.arange(n)
        exit_, count = self.run(classes, begin, end, entry)
        rounds = 0
        inner = np.append(~free[1:], False)  # the next chunk belongs to the same run
        while True:
            # row i maps entry[i] of chunk[i] to exit_[i]; link it to the row that goes on from there
            rows = IntMap(2 * len(chunk))
            rows.add(chunk << 32 | entry, np.arange(len(chunk)))
            goes_on = inner[chunk]
            link = np.where(goes_on, rows.get((chunk + 1) << 32 | exit_), np.arange(len(chunk)))
            lacks = link == ABSENT
            link[lacks] = np.flatnonzero(lacks)
            ends = link == np.arange(len(chunk))
            total, at = count.copy(), link.copy()
            total = np.where(ends, 0, total)
            while not ends[at].all():
                total = total + total[at]
                at = at[at]
            heads = np.flatnonzero(free[chunk])
            if not lacks[at[heads]].any():
                out = np.zeros(n, np.int64)
                out[chunk[heads]] = total[heads] + count[at[heads]]
                return out
            stuck = np.unique(at[heads][lacks[at[heads]]])
            new, state = chunk[stuck] + 1, exit_[stuck]
            rounds += 1
            if rounds > 4:  # a periodic run: the state that enters here likely enters the next chunks too
                ahead = new[:, None] + np.arange(AHEAD)
                run_end = np.flatnonzero(~inner)[np.searchsorted(np.flatnonzero(~inner), new)]
                keys = (ahead << 32 | state[:, None])[ahead <= run_end[:, None]]
                keys = np.setdiff1d(keys, chunk << 32 | entry)
                new, state = keys >> 32, keys & 0xFFFFFFFF
            more_exit, more_count = self.run(classes, begin[new], end[new], state)
            chunk, entry = np.append(chunk, new), np.append(entry, state)
            exit_, count = np.append(exit_, more_exit), np.append(count, more_count)


def count_tokens(
    df: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text."""

    def work(ids, texts):
        n = Transducer.load(path).count(texts)
        return {
            "id": ids,
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": n,
            "over_limit": [x > limit for x in n],
        }

    return map_texts(df, id_col, text_col, "id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", work)
