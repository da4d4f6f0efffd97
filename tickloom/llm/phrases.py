"""Phrases whose words occur together, counted in tries of hash containers.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at spaces and tabs. Phrases of one word are
counted first, then longer ones from two words on. A phrase with ``least`` occurrences has such parts only, so a phrase is counted only if its first
and last parts of one word less may have as many: a bit set of two hashes for every such part tells, never wrongly for one that has (at most
``SIEVE_BITS``: 32 MB, what goes to the driver and with the tasks). Counts are those of all texts, whatever the bit set lets through.

Counting: every task holds a trie over the numbers it gives to words. A container is a hash table from the rest of a phrase to its count; one that
outgrows ``BURST`` entries bursts into a node with a container for each next word, so frequent beginnings get a level of their own and rare ones share
one. When the trie holds ``HELD`` phrases, its largest subtrees are spilled whole, each as a run sorted by phrase, until half of them are left; at
the end all are. Runs are dealt by prefix partition (the first word and a hash of the phrase over ``SLOTS``, so a frequent first word is
spread over tasks), and the runs of a partition are merged into sums.

Scores: a phrase of frequency a is cut after its first k words into parts of frequencies l and r; floor(``SCALE`` a a / (l r)), in exact decimal
arithmetic; the lowest cut counts, ties to the smallest k. A candidate inside a longer candidate with ``share`` percent of its frequency goes. Then each
group's best phrases are ranked, first within hashed parts of the group, so that no task sorts a whole group.

Null texts count as empty, a null group is named ``und``. Repeated rows count as often as they occur. Empty tables give no phrases. Other columns
are not read. A very long text is worked on whole, but its words are short-lived.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import arrow_schema, batch_of, discard, steps, stored, text_of

#: Marks and line ends that end a piece; a tab stands for a space.
ENDS = b".,;:!?\n\x0b\x0c\r"
TO_LINES = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
#: Entries of a container before it bursts, phrases of a trie before it spills, words that a task numbers at once.
BURST, HELD, WORDS = 4_096, 600_000, 400_000
#: Prefix partitions of one first word.
SLOTS = 64
#: Bits for each part that the bit set knows, and its most bits.
BITS_EACH, SIEVE_BITS = 16, 1 << 28
SEGMENT = 1 << 18
RUN = "lang string, phrase string, n bigint"
SCALE = 1_000_000
UND = "und"


# --- the trie


class Node(dict):
    """Next word to a node or a container."""


class HatTrie:
    """Counts of phrases of ``words`` numbered words; a phrase is one integer of 32 bits a word, the first word highest."""

    def __init__(self, words: int, burst: int = BURST):
        self.words, self.burst, self.held = words, burst, 0
        self.root: Node | dict = {}

    def add(self, phrases: list[int], counts: list[int]) -> None:
        for phrase, n in zip(phrases, counts, strict=True):
            at, over, word, rest, bits = self.root, None, 0, phrase, 32 * (self.words - 1)
            while at.__class__ is Node:
                over, word, rest = at, rest >> bits, rest & ((1 << bits) - 1)
                at = over.get(word)
                if at is None:
                    at = over[word] = {}
                bits -= 32
            if rest in at:
                at[rest] += n
                continue
            at[rest] = n
            self.held += 1
            if len(at) > self.burst and bits > 0:
                node = self._split(at, bits)
                if over is None:
                    self.root = node
                else:
                    over[word] = node

    def _split(self, box: dict, bits: int) -> Node:
        node, mask = Node(), (1 << bits) - 1
        for rest, n in box.items():
            node.setdefault(rest >> bits, {})[rest & mask] = n
        return node

    def _walk(self, at, prefix: int, bits: int, out: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
        if at.__class__ is Node:
            for word, below in at.items():
                self._walk(below, prefix | word << bits, bits - 32, out)
        else:
            out[0].extend([prefix | rest for rest in at])
            out[1].extend(at.values())
        return out

    def _size(self, at) -> int:
        return sum(map(self._size, at.values())) if at.__class__ is Node else len(at)

    def spill(self, left: int = 0) -> tuple[list[int], list[int]]:
        """Take the largest subtrees out whole, until at most ``left`` phrases are held; their phrases and counts."""
        top, out = 32 * (self.words - 1), ([], [])
        if self.root.__class__ is not Node or not left:
            self._walk(self.root, 0, top, out)
            self.root, self.held = {}, 0
            return out
        sizes = sorted(((self._size(below), word) for word, below in self.root.items()), reverse=True)
        for size, word in sizes:
            if self.held <= left:
                break
            self._walk(self.root.pop(word), word << top, top - 32, out)
            self.held -= size
        return out


# --- words of texts


class Numbers(dict):
    """Words to numbers from 1 on; 0 ends a piece, -1 is no word. ``hashes`` has the 64-bit hash of each."""

    def __init__(self, lang: str):
        super().__init__({b"\n": 0, b"": -1})
        self.seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        self.names: list[bytes] = [b""]
        self.fresh: list[bytes] = []
        self.hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.names)
        self.names.append(word)
        self.fresh.append(word)
        return i

    def of(self, text: str) -> np.ndarray:
        parts = text.encode().lower().translate(TO_LINES).replace(b"\n", b" \n ").split(b" ")
        return np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))

    def hashed(self) -> np.ndarray:
        if self.fresh:
            seed = self.seed
            new = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.fresh), np.uint64, len(self.fresh))
            self.hashes, self.fresh = np.concatenate([self.hashes, new]), []
        return self.hashes


def chained(held: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last, and the last word's."""
    with np.errstate(over="ignore"):
        x = (held * np.uint64(0x9E3779B97F4A7C15)) ^ (nxt + (held >> np.uint64(29)))
        return x ^ (x >> np.uint64(32))


class Sieve:
    """The bit set of the phrases that are frequent enough."""

    def __init__(self, bits: int, segments: dict[int, bytes]):
        self.bits = bits
        self.words = np.zeros(bits // 8, np.uint8)
        for number, data in segments.items():
            self.words[number * SEGMENT // 8 :][: len(data)] = np.frombuffer(data, np.uint8)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(bits - 1)
        return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        a, b = self.places(hashes, self.bits)
        return ((self.words[a >> 3] >> (a & 7)) & (self.words[b >> 3] >> (b & 7)) & 1).astype(bool)


def make_sieve(frequent: DataFrame) -> Sieve:
    """Of the (lang, phrase) given; the bits are set in segments, in parallel."""
    room = max(SEGMENT, min(SIEVE_BITS, BITS_EACH * frequent.count()))
    bits = 1 << (room - 1).bit_length()
    kind, out_kind = arrow_schema("segment int, place int"), arrow_schema("segment int, data binary")

    def hashed(batches):
        for b in batches:
            found = []
            for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seed = xxhash.xxh64_intdigest(lang.encode(), 42)
                h = None
                for w in phrase.encode().split(b" "):
                    x = np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64)
                    h = x if h is None else chained(h, x)
                found.append(h[0])
            at = np.concatenate(Sieve.places(np.array(found, np.uint64), bits))
            yield from _batches(kind, [(at // SEGMENT).tolist(), (at % SEGMENT).tolist()])

    def filled(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            segment, place = b.column(0).to_numpy(), b.column(1).to_numpy()
            for s in np.unique(segment):
                box = held.setdefault(int(s), np.zeros(SEGMENT // 8, np.uint8))
                at = place[segment == s]
                np.bitwise_or.at(box, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield from (batch_of([(s, box.tobytes())], out_kind) for s, box in held.items())

    places = frequent.select("lang", "phrase").mapInArrow(hashed, "segment int, place int").distinct()
    made = places.repartition("segment").mapInArrow(filled, "segment int, data binary").collect()
    return Sieve(bits, {r.segment: r.data for r in made})


def _batches(kind, columns: list[list]):
    if columns[0]:
        yield batch_of(list(zip(*columns, strict=True)), kind)


# --- counting


class Counter:
    """Counts of one language's phrases of ``words`` words in one task."""

    def __init__(self, lang: str, words: int, sieve: Sieve | None):
        self.lang, self.words, self.sieve = lang, words, sieve
        self.numbers, self.trie = Numbers(lang), HatTrie(words)

    def add(self, texts: list[str]) -> None:
        ids = np.concatenate([x for t in texts for x in (self.numbers.of(t), np.zeros(1, np.int64))])
        ids = ids[ids >= 0]
        starts = self._starts(ids)
        code = ids[starts]
        first = np.arange(len(starts))
        for j in range(1, self.words):
            if j > 1:  # two numbers fit one integer; a longer phrase goes by that of its beginning
                _, first, code = np.unique(code, return_index=True, return_inverse=True)
            code = code << 32 | ids[starts + j]
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        columns = [ids[starts[first] + j].tolist() for j in range(self.words)]
        phrases = columns[0]
        for column in columns[1:]:
            phrases = [p << 32 | w for p, w in zip(phrases, column, strict=True)]
        self.trie.add(phrases, counts.tolist())

    def _starts(self, ids: np.ndarray) -> np.ndarray:
        """Places where a phrase begins whose parts of one word less may be frequent."""
        if self.words == 1:
            return np.flatnonzero(ids > 0)
        part, n = self.words - 1, len(ids) - self.words + 2
        hashes = self.numbers.hashed()
        if n <= 1:
            return np.zeros(0, np.int64)
        if part == 1:
            frequent = np.zeros(len(hashes), bool)
            frequent[1:] = self.sieve.has(hashes[1:])
            ok = frequent[ids]
        else:
            ok, h = ids[:n] > 0, hashes[ids[:n]]
            for j in range(1, part):
                ok &= ids[j : n + j] > 0
                h = chained(h, hashes[ids[j : n + j]])
            ok[ok] = self.sieve.has(h[ok])
        return np.flatnonzero(ok[:-1] & ok[1:])

    def spill(self, left: int = 0):
        """The runs of the subtrees taken out, sorted by phrase, as batches of ``RUN``."""
        phrases, counts = self.trie.spill(left)
        if not phrases:
            return
        names = pa.array(self.numbers.names, pa.binary())
        if self.words <= 2:
            packed = np.array(phrases, np.int64)
            numbers = [packed >> 32, packed & 0xFFFFFFFF] if self.words == 2 else [packed]
        else:
            numbers = [np.array([p >> b & 0xFFFFFFFF for p in phrases], np.int64) for b in range(32 * (self.words - 1), -1, -32)]
        spelt = pc.binary_join_element_wise(*[names.take(pa.array(x)) for x in numbers], b" ") if self.words > 1 else names.take(pa.array(numbers[0]))
        spelt, counts = spelt.cast(pa.string()), pa.array(counts, pa.int64())
        order = pc.sort_indices(spelt)
        for i in range(0, len(order), 50_000):
            part = order[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(self.lang), len(part)), spelt.take(part), counts.take(part)], names=["lang", "phrase", "n"])

    def rows(self, done: bool):
        """Runs to write now: all of them at the end or when many words are numbered, else what is too much."""
        many = len(self.numbers.names) > WORDS
        if done or many:
            yield from self.spill()
            if many:
                self.numbers = Numbers(self.lang)
        elif self.trie.held > HELD:
            yield from self.spill(HELD // 2)


def count_phrases(df: DataFrame, words: int, sieve: Sieve | None = None, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, n): the sums of all tasks' runs. With a sieve, at least all phrases that it lets through."""
    shared = df.sparkSession.sparkContext.broadcast(sieve)

    def run(batches):
        counters: dict[str, Counter] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in steps(texts):
                by: dict[str, list[str]] = {}
                for lang, text in zip(langs[i:j], texts[i:j], strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, mine in by.items():
                    c = counters.get(lang)
                    if c is None:
                        c = counters[lang] = Counter(lang, words, shared.value)
                    c.add(mine)
                    yield from c.rows(False)
            # many languages share the room of one
            while sum(c.trie.held for c in counters.values()) > 2 * HELD or len(counters) > 1_000:
                largest = max(counters, key=lambda x: (counters[x].trie.held, x))
                yield from counters.pop(largest).rows(True)
        for c in counters.values():
            yield from c.rows(True)

    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UND)).alias("lang"), text_of(text_col).alias("text"))
    runs = texts.mapInArrow(run, RUN)
    slot = F.pmod(F.xxhash64("phrase"), F.lit(SLOTS))
    dealt = runs.withColumn("head", F.substring_index("phrase", " ", 1)).withColumn("slot", slot)
    if words == 1:
        return runs.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    dealt = dealt.repartition("lang", "head", "slot")
    return dealt.groupBy("lang", "head", "slot", "phrase").agg(F.sum("n").alias("n")).select("lang", "phrase", "n")


# --- collocations


def _head(words: int, n: int) -> Column:
    return F.substring_index("phrase", " ", n)


def _tail(words: int, n: int) -> Column:
    return F.substring_index("phrase", " ", n - words)


def collocations(
    df: DataFrame, longest: int = 3, least: int = 10, share: int = 50, best: int | None = 2_000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each group's ``best`` phrases of 2 to ``longest`` words (None: all)."""
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words and one occurrence at least")
    spark = df.sparkSession
    words, words_path = stored(count_phrases(df, 1, None, lang_col, text_col), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    totals, totals_path = stored(totals, "totals")
    frequent = [words.where(F.col("n") >= least)]
    paths = [words_path, totals_path]
    for size in range(2, longest + 1):
        counted = count_phrases(df, size, make_sieve(frequent[-1]), lang_col, text_col).where(F.col("n") >= least)
        counted, path = stored(counted, "phrases")
        frequent.append(counted)
        paths.append(path)
    scored = longer = None
    for size in range(2, longest + 1):
        held = frequent[size - 1].withColumnRenamed("n", "a")
        for k in range(1, size):
            # merge joins split skewed keys; the stored tables' compressed sizes are no bound for a broadcast
            for name, part, of in (("l", _head(size, k), k), ("r", _tail(size, k), size - k)):
                side = frequent[of - 1].select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("n").alias(f"{name}{k}"))
                held = held.join(side.hint("merge"), (F.col("lang") == F.col("p_lang")) & (part == F.col("part"))).drop("p_lang", "part")
        cuts = []
        for k in range(1, size):
            score = F.expr(f"(CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * {SCALE}BD) div (CAST(l{k} AS DECIMAL(19,0)) * CAST(r{k} AS DECIMAL(19,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        low = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        part = held.select("lang", "phrase", "a", F.lit(size).alias("size"), low.alias("low")).select("lang", "phrase", "a", "size", "low.score", "low.l", "low.r")
        scored = part if scored is None else scored.unionByName(part)
        if size > 2:
            at = F.split("phrase", " ")
            inner = [F.array_join(F.slice(at, i, s), " ") for s in range(2, size) for i in range(1, size - s + 2)]
            part = frequent[size - 1].select("lang", F.explode(F.array_distinct(F.array(*inner))).alias("phrase"), F.col("n").alias("longer"))
            longer = part if longer is None else longer.unionByName(part)
    if longer is not None:
        most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(most.hint("merge"), ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    scored, path = stored(scored.select("lang", "phrase", "a", "l", "r", "score"), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    if best is None:
        ranked = scored.withColumn("rank", rank)
    else:
        slot = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS))).orderBy(*order))
        ranked = scored.withColumn("slot", slot).where(F.col("slot") <= best).drop("slot").withColumn("rank", rank).where(F.col("rank") <= best)
    out = ranked.join(totals.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    out, _ = stored(out, "collocations")
    discard(spark, *paths, path)
    return out
