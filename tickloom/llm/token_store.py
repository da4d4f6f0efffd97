"""Token ids in binary shards, and a minimal perfect hash index from document keys to their places.

Writing: texts become ids where they are read, and only ids are shuffled. Rows go to ranges of (key, hash of the text) by cuts from a
sample of the rows; every range, sorted, becomes one shard, so the shards in turn hold all documents by ascending key (nulls first,
equal keys by the hash of their text). Equal rows may fall on either side of a cut that equals them, so a key of very many rows is
spread over shards as well.

A shard is ``MAGIC``, the bytes of an id (2 or 4) as a little-endian 32-bit integer, the raw ids of its documents, the end of every document
(ids from the shard's start) as 64-bit integers, and a trailer of two 64-bit integers: documents and ids.

Index: keys are hashed to 128 bits and dealt to buckets of about ``BUCKET_KEYS``. In every bucket a key's slot is the rank of its bit in a
cascade of bit sets: a key that is alone on its bit stays at that level, the others go on to the next, about two bits a key and level.
So n keys have the slots 0 to n - 1 without keeping the keys. A slot has a fingerprint of 32 bits, by which unknown keys are refused (but for one
in four billion), the place of the key's first document (shard, number in it) and the number of documents under the key, which
follow each other. A look-up reads one bucket, then two ends and one range of ids.

Only ids of shards and buckets (about 100 bytes for a shard of some 100 MB or 100,000 keys) go to the driver and with the tasks. Files are named
by task attempt and referred to by committed rows only, so a lost executor leaves unused files at most.

Null text counts as empty: the end id alone. Rows with a null key are found under the null key, repeated rows are kept. Other columns are not read.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.llm.bpe_codec import WIDE, Codec, PairTable
from tickloom.llm.common import arrow_schema, batch_of, steps, stored, text_of
from tickloom.llm.warc import _file_system
from tickloom.session import scratch

MAGIC = b"tokshard"
HEAD = len(MAGIC) + 4
#: Keys of an index bucket, on average, and the bits of a level for each key that reaches it.
BUCKET_KEYS, GAMMA = 100_000, 2.0
#: Documents that one group of reads takes from a shard in turn.
STRIDE = 1_000
#: Chunks of text remembered by a worker in each of two generations.
REMEMBERED = 300_000
#: Rows sampled for each cut between shards.
PER_CUT = 50
#: A chunk of two pieces of the usual byte-level pattern: letters, and marks that end it; a line feed may stand before.
PLAIN, MARKS = r"^\n?[A-Za-zÀ-ÖØ-öø-ɏ]+[.,;:!?]*$", ".,;:!?"
LETTERS = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x250)]))
IDS = pa.large_binary()
RUN = "h1 bigint, h2 bigint, shard int, ordinal bigint, n_docs bigint, n_ids bigint, file string"
BUCKET = "bucket int, file string, offset bigint, length bigint, n_keys bigint"
SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("ordinal", "<u8"), ("n_docs", "<u8")])


# --- texts to ids


class WordMerges(Codec):
    """Merges of short words, many at once on op1's matrices, by the pairs that a tokenizer file lists."""

    def __init__(self, vocab: dict[str, int], merges: list, byte_of: dict[str, int]):
        self.single = np.zeros(256, np.int32)
        for sign, byte in byte_of.items():
            self.single[byte] = vocab[sign]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        whole = [vocab[a + b] for a, b in pairs]
        #: An id stands for the rank of its pair only if the file lists the pairs by rising id.
        self.by_rank = all(x < y for x, y in zip(whole, whole[1:], strict=False))
        self.pairs = PairTable([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], whole, max(vocab.values()) + 1)

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of at most ``WIDE`` bytes as little-endian 32-bit integers."""
        return self._pieces(words)


class ChunkIds:
    """Ids of whole texts by a byte-level tokenizer, from remembered chunks.

    A byte-level pattern ends a piece before a space or line feed that follows another sign, and takes a line feed alone before another
    sign. So a text is its first word and the chunks that such spaces and line feeds start (the space is left out of a chunk's name), but for
    texts in which white space follows white space: those are cut only before single spaces between other signs.

    Arrow splits the texts and finds the distinct chunks of a step, and only those are worked on one by one. Chunks of Latin letters and
    closing marks are two pieces: the letters (with their space) are merged together on matrices by the file's own pairs and remembered
    without the marks, the marks have a memory of their own. Other new chunks go through the library, where a short one costs some
    12 microseconds. Whole texts go through the library if the tokenizer's chain is not the usual one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = tokenizers.Tokenizer.from_file(path)
        with open(path) as f:
            chain = json.load(f)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        shifted = iter(range(0x100, 0x200))
        byte_of = {chr(b if b in plain else next(shifted)): b for b in range(256)}
        self.usual = self._usual(chain)
        if self.usual:
            self.merges = WordMerges(chain["model"]["vocab"], chain["model"]["merges"], byte_of)
            self.usual = self.merges.by_rank
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        #: Words by their bytes, other chunks by their names.
        self.known: dict[bytes | str, bytes] = {}
        self.former: dict[bytes | str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    @staticmethod
    def _usual(chain: dict) -> bool:
        pre, model = chain.get("pre_tokenizer") or {}, chain["model"]
        fixed = (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True)
        added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.fullmatch(r"\s|[^\W\d_]+[.,;:!?]*|.*\s.*", t["content"])) for t in chain["added_tokens"])
        return fixed and added and not chain.get("normalizer") and model["type"] == "BPE" and not (model.get("ignore_merges") or model.get("dropout"))

    @staticmethod
    @lru_cache(2)
    def load(path: str) -> ChunkIds:
        return ChunkIds(path)

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def whole(self, text: str) -> bytes:
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def _mark(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks = {}
            self.marks[marks] = self.whole(marks)
        return self.marks[marks]

    def _recalled(self, names: list, learn) -> list[bytes]:
        """Ids of distinct words or chunks; ``learn`` gives those of new ones."""
        known, former = self.known, self.former
        out = list(map(known.get, names))
        new = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            if (ids := former.get(names[i])) is None:
                new.append(i)
            else:
                out[i] = known[names[i]] = ids
        for i, ids in zip(new, learn([names[i] for i in new]), strict=True):
            out[i] = known[names[i]] = ids
        return out

    def _merged(self, words: list[bytes]) -> list[bytes]:
        coded = self.merges.words(words)
        flat = np.frombuffer(b"".join(coded), "<u4").astype(f"<u{self.width}").tobytes()
        ends = list(accumulate(len(c) // 4 * self.width for c in coded))
        return [flat[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def _plain(self, chunks: pa.Array) -> pa.Array:
        """Ids of distinct chunks of letters and closing marks."""
        fed = pc.starts_with(chunks, "\n")
        lead = pc.if_else(fed, pa.scalar("", chunks.type), pa.scalar(" ", chunks.type))
        letters = pc.ascii_rtrim(pc.ascii_ltrim(chunks, "\n"), MARKS)
        words = pc.binary_join_element_wise(lead, letters, pa.scalar("", chunks.type)).cast(IDS).dictionary_encode()
        ids = pa.array(self._recalled(_listed(words.dictionary), self._merged), IDS).take(words.indices)
        marks = pc.utf8_ltrim(chunks, "\n" + LETTERS).dictionary_encode()
        closing = pa.array([self._mark(m) if m else b"" for m in _listed(marks.dictionary)], IDS).take(marks.indices)
        feed = pc.if_else(fed, pa.scalar(self._mark("\n"), IDS), pa.scalar(b"", IDS))
        return pc.binary_join_element_wise(feed, ids, closing, pa.scalar(b"", IDS))

    def _chunks(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of distinct chunks by name, and which of them are empty or end in white space: what follows may belong to that."""
        plain = pc.and_(pc.match_substring_regex(chunks, PLAIN), pc.less(pc.binary_length(chunks), WIDE))
        other = _listed(chunks.filter(pc.invert(plain)))
        ids = [
            self._plain(chunks.filter(plain)),
            pa.array(self._recalled(other, lambda new: [self.whole(c if c[:1] == "\n" else " " + c) for c in new]), IDS),
        ]
        plain = plain.to_numpy(zero_copy_only=False)
        blank = np.zeros(len(chunks), bool)
        blank[~plain] = [_blank(c) for c in other]
        place = np.where(plain, np.cumsum(plain), plain.sum() + np.cumsum(~plain)) - 1
        return pa.concat_arrays(ids).take(pa.array(place)), blank

    def _joined(self, chunks: pa.Array, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Ids of texts, whose chunks start at ``at``, the first word before them; and whether white space ends one that others follow."""
        first = np.zeros(len(chunks), bool)
        first[at] = True
        coded = chunks.filter(pa.array(~first)).dictionary_encode()
        ids, blank = self._chunks(coded.dictionary)
        starts = _listed(chunks.filter(pa.array(first)))
        place = np.empty(len(chunks), np.int64)
        place[~first] = coded.indices.to_numpy()
        place[first] = len(ids) + np.arange(len(at))
        taken = pa.concat_arrays([ids, pa.array(map(self.whole, starts), IDS)]).take(pa.array(place))
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64)[[*at, len(chunks)]].tolist()
        odd = np.add.reduceat(np.concatenate([blank, [_blank(s) for s in starts]])[place], at, dtype=np.int64) > 0
        return [data[i:j].to_pybytes() for i, j in zip(ends, ends[1:], strict=False)], odd

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, ``width`` bytes each."""
        if not self.usual:
            return [self.whole(t) for t in texts]
        if not texts:
            return []
        if len(self.known) > REMEMBERED:
            self.known, self.former = {}, self.known
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        out, odd = self._joined(split.values, split.offsets.to_numpy()[:-1])
        again = np.flatnonzero(odd).tolist()
        if again:  # texts in which white space may follow white space
            chunks, at = [], []
            for i in again:
                word, *rest = re.split(r"(?<=\S)(?= \S)", texts[i])
                at.append(len(chunks))
                chunks += [word, *(c[1:] for c in rest)]
            for i, ids in zip(again, self._joined(pa.array(chunks, pa.large_string()), np.array(at))[0], strict=True):
                out[i] = ids
        return out


def _listed(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


def _blank(chunk: str) -> bool:
    return not chunk or chunk[-1].isspace()


# --- minimal perfect hashing


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h1 + h2 * np.uint64(2 * level + 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 128-bit keys to the numbers 0 to n - 1. Unknown keys get any number, or -1."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def build(h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(h1):
            if len(sizes) == 200:
                raise ValueError("two keys have the same 128 bits")
            size = -(-int(GAMMA * len(h1) + 64) // 64) * 64
            at = (_mixed(h1, h2, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            again = ~alone[at]
            h1, h2 = h1[again], h2[again]
        return PerfectHash(sizes, np.concatenate(parts) if parts else np.zeros(0, "<u8"))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), -1, np.int64)
        left, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + (_mixed(h1[left], h2[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[at >> 6] + below)[hit]
            left, base = left[~hit], base + size
            if not len(left):
                break
        return out

    def to_bytes(self) -> bytes:
        return struct.pack(f"<I{len(self.sizes)}Q", len(self.sizes), *self.sizes) + self.words.tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<I", raw)
        sizes = list(struct.unpack_from(f"<{n}Q", raw, 4))
        return PerfectHash(sizes, np.frombuffer(raw, "<u8", sum(sizes) // 64, 4 + 8 * n))


def make_bucket(h1: np.ndarray, h2: np.ndarray, shard: np.ndarray, ordinal: np.ndarray, n_docs: np.ndarray) -> bytes:
    """The index of one bucket: the hash function's length and bytes, then the slots."""
    keys = PerfectHash.build(h1, h2)
    table = np.zeros(len(h1), SLOT)
    at = keys.slots(h1, h2)
    table["mark"][at], table["shard"][at], table["ordinal"][at], table["n_docs"][at] = h2 & np.uint64(0xFFFFFFFF), shard, ordinal, n_docs
    raw = keys.to_bytes()
    return struct.pack("<Q", len(raw)) + raw + table.tobytes()


def ask_bucket(raw: bytes, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which keys are known, their slots)."""
    (size,) = struct.unpack_from("<Q", raw)
    keys, table = PerfectHash.from_bytes(raw[8 : 8 + size]), np.frombuffer(raw, SLOT, offset=8 + size)
    at = keys.slots(h1, h2)
    found = at >= 0
    found[found] = table["mark"][at[found]] == (h2[found] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return found, table[at[found]]


def key_hashes(key: Column) -> list[Column]:
    text = key.cast("string")
    return [F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit("")).alias("h2")]


# --- writing


def _order(key, tie: int) -> tuple:
    return (key is not None, 0 if key is None else key, tie)


def _cuts(rows: DataFrame, shards: int) -> list[tuple]:
    """Shard boundaries from a sample of ``PER_CUT`` rows a shard, about; they only place the work."""
    share = min(1.0, PER_CUT * shards / max(1, rows.count()))
    seen = sorted(_order(*r) for r in rows.select("id", "tie").sample(share, seed=7).collect())
    return [seen[i * len(seen) // shards] for i in range(1, shards)] if seen else []


class TokenStore:
    """Shards and index in one folder. ``shards``: (first id, documents, file) by shard number; ``buckets``: (file, offset, length)."""

    def __init__(self, folder: str, width: int, shards: list[tuple], buckets: list[tuple | None]):
        self.folder, self.width, self.shards, self.buckets = folder, width, shards, buckets

    @staticmethod
    def write(df: DataFrame, path: str, end_id: int = 0, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> TokenStore:
        """Encode ``text_col`` of every row, append ``end_id``, write shards and index; ``path`` names the tokenizer's file."""
        spark = df.sparkSession
        shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        folder = scratch(spark, "tokens")
        if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:|/", folder):
            raise ValueError("the shared folder needs an absolute address")
        rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
        cuts = _cuts(rows, shards)
        width = ChunkIds.load(path).width
        kind = StructType([StructField("id", df.schema[id_col].dataType), *_fields("tie bigint, shard int, ids binary")])
        arrow = arrow_schema(_ddl(kind))
        mark = struct.pack("<H" if width == 2 else "<I", end_id)

        def encode(batches):
            coder, turn = ChunkIds.load(path), 0
            for b in batches:
                keys, texts, ties = (c.to_pylist() for c in b.columns)
                for i, j in steps(texts):
                    places = []
                    for key, tie in zip(keys[i:j], ties[i:j], strict=True):
                        at = _order(key, tie)
                        low, high = bisect.bisect_left(cuts, at), bisect.bisect_right(cuts, at)
                        places.append(low + turn % (high - low + 1))
                        turn += 1
                    coded = [c + mark for c in coder.encode(texts[i:j])]
                    columns = [keys[i:j], ties[i:j], places, coded]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        coded = rows.mapInArrow(encode, kind)
        dealt = coded.repartition(shards, "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "tie")
        hashed = dealt.select(*key_hashes(F.col("id")), "shard", "ids")
        runs, _ = stored(hashed.mapInArrow(_shard_writer(folder, width), RUN), "runs")
        made = runs.groupBy("shard", "file").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
        sizes = {r.shard: r for r in made.collect()}
        held, first = [], 0
        for s in range(max(sizes, default=-1) + 1):
            r = sizes.get(s)
            held.append((first, r.n_docs if r else 0, r.file if r else ""))
            first += r.n_ids if r else 0
        return TokenStore(folder, width, held, _write_index(runs, folder))

    # --- reading

    def read(self, keys: DataFrame, key_col: str = "doc_id", ids: bool = True) -> DataFrame:
        """(id, start, n_tokens, ids_crc32[, ids]) of every document under the keys asked for, each key once.

        ``start`` counts the ids of all documents before it; the checksum is of 32-bit ids. Unknown keys give no row.
        """
        spark = keys.sparkSession
        kind = keys.schema[key_col].dataType
        asked = keys.select(F.col(key_col).alias("id")).distinct().select("id", *key_hashes(F.col("id")))
        asked = asked.withColumn("bucket", F.pmod("h1", F.lit(len(self.buckets) or 1)))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found_kind = StructType([StructField("id", kind), *_fields("shard int, ordinal bigint, n_docs bigint")])
        places = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(self._find(found_kind), found_kind)
        # a number of its own: places are short rows that stand for long reads
        grouped = places.repartition(parts, "shard", F.floor(F.col("ordinal") / STRIDE)).sortWithinPartitions("shard", "ordinal")
        out_kind = StructType([StructField("id", kind), *_fields("start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids)])
        return grouped.mapInArrow(self._fetch(out_kind, ids), out_kind)

    def _find(self, schema: StructType):
        store, arrow = self, arrow_schema(_ddl(schema))

        def run(batches):
            system, root = _file_system(store.folder)
            number, raw = None, b""
            for b in batches:
                keys, bucket = b.column(0), b.column(3).to_numpy()
                h1, h2 = (b.column(c).to_numpy().view(np.uint64) for c in (1, 2))
                for g in np.unique(bucket):
                    if not store.buckets or store.buckets[g] is None:
                        continue
                    if number != g:
                        file, offset, length = store.buckets[g]
                        with system.open_input_file(f"{root}/{file}") as f:
                            number, raw = g, f.read_at(length, offset)
                    here = np.flatnonzero(bucket == g)
                    known, slots = ask_bucket(raw, h1[here], h2[here])
                    rows = []
                    for key, slot in zip(keys.take(pa.array(here[known])).to_pylist(), slots, strict=True):
                        rows += [(key, *place) for place in store._pieces(int(slot["shard"]), int(slot["ordinal"]), int(slot["n_docs"]))]
                    if rows:
                        yield batch_of(rows, arrow)

        return run

    def _pieces(self, shard: int, ordinal: int, n: int):
        """Places of ``n`` documents from one on, at most ``STRIDE`` in a piece; they may go on in the next shards."""
        while n:
            here = min(n, self.shards[shard][1] - ordinal, STRIDE)
            if here:
                yield shard, ordinal, here
            n, ordinal = n - here, ordinal + here
            if ordinal >= self.shards[shard][1]:
                shard, ordinal = shard + 1, 0

    def _fetch(self, schema: StructType, with_ids: bool):
        store, arrow = self, arrow_schema(_ddl(schema))

        def run(batches):
            reader = ShardReader(store)
            for b in batches:
                rows, held = [], 0
                for key, shard, ordinal, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    for start, raw in reader.documents(shard, ordinal, n):
                        wide = np.frombuffer(raw, f"<u{store.width}").astype("<u4")
                        rows.append((key, start, len(wide), zlib.crc32(wide), *([raw] if with_ids else [])))
                        held += len(raw) if with_ids else 100
                        if held > 8 << 20:
                            yield batch_of(rows, arrow)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows, arrow)

        return run

    def get(self, key) -> list[list[int]]:
        """The ids of every document under one key, by two reads for the key and two for each document."""
        text = b"" if key is None else str(key).encode()
        h1 = h2 = 42 if key is None else xxhash.xxh64_intdigest(text, 42)
        h2 = xxhash.xxh64_intdigest(b"", h2)
        if not self.buckets:
            return []
        signed = h1 - (1 << 64) if h1 >> 63 else h1
        place = self.buckets[signed % len(self.buckets)]
        if place is None:
            return []
        system, root = _file_system(self.folder)
        with system.open_input_file(f"{root}/{place[0]}") as f:
            known, slots = ask_bucket(f.read_at(place[2], place[1]), np.array([h1], np.uint64), np.array([h2], np.uint64))
        reader, out = ShardReader(self), []
        for slot in slots:
            for piece in self._pieces(int(slot["shard"]), int(slot["ordinal"]), int(slot["n_docs"])):
                out += [np.frombuffer(raw, f"<u{self.width}").tolist() for _, raw in reader.documents(*piece)]
        return out


class ShardReader:
    """Ranges of documents from shards; the last shard stays open."""

    def __init__(self, store: TokenStore):
        self.store, self.shard, self.file = store, None, None
        self.system, self.root = _file_system(store.folder)

    def documents(self, shard: int, ordinal: int, n: int):
        """(start, raw ids) of ``n`` neighbouring documents."""
        first, n_docs, name = self.store.shards[shard]
        if self.shard != shard:
            if self.file is not None:
                self.file.close()
            self.file, self.shard = self.system.open_input_file(f"{self.root}/{name}"), shard
            self.size = self.file.size()
            if self.file.read_at(HEAD, 0) != MAGIC + struct.pack("<I", self.store.width):
                raise ValueError(f"{name} is no shard of this store")
        before = min(ordinal, 1)
        at = self.size - 16 - 8 * (n_docs - ordinal + before)
        ends = np.frombuffer(self.file.read_at(8 * (n + before), at), "<u8").tolist()
        ends = ends if before else [0, *ends]
        width = self.store.width
        for low, high in zip(ends, ends[1:], strict=False):
            yield first + low, self.file.read_at(width * (high - low), HEAD + width * low)


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _shard_writer(folder: str, width: int):
    kind = arrow_schema(RUN)

    def run(batches):
        context = TaskContext.get()
        system, root = _file_system(folder)
        out, shard, name, ends, total = None, None, "", [], 0

        def close():
            out.write(np.array(ends, "<u8").tobytes() + struct.pack("<QQ", len(ends), total))
            out.close()

        last = None  # the run of equal keys that is still open
        for b in batches:
            rows = []
            for h1, h2, s, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard:
                    if out is not None:
                        close()
                    shard, name, ends, total = s, f"shard-{s:06d}-{context.taskAttemptId()}.ids", [], 0
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(MAGIC + struct.pack("<I", width))
                out.write(raw)
                n = len(raw) // width
                if last is not None and last[:3] == [h1, h2, s]:
                    last[4] += 1
                    last[5] += n
                else:
                    if last is not None:
                        rows.append(tuple(last))
                    last = [h1, h2, s, len(ends), 1, n, name]
                total += n
                ends.append(total)
            if rows:
                yield batch_of(rows, kind)
        if out is not None:
            close()
            yield batch_of([tuple(last)], kind)

    return run


def _write_index(runs: DataFrame, folder: str) -> list[tuple | None]:
    """The bucket directory; a key's documents follow each other, so its first place and their number are kept."""
    keys = runs.groupBy("h1", "h2").agg(F.min(F.struct("shard", "ordinal")).alias("first"), F.sum("n_docs").alias("n_docs"))
    buckets = -(-runs.count() // BUCKET_KEYS)
    if not buckets:
        return []
    kind = arrow_schema(BUCKET)

    def run(batches):
        context = TaskContext.get()
        system, root = _file_system(folder)
        name = f"index-{context.partitionId():06d}-{context.taskAttemptId()}.mph"
        out, offset, number, held, rows = None, 0, None, [], []

        def close():
            nonlocal out, offset
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            columns = [np.concatenate([h[i] for h in held]) for i in range(5)]
            data = make_bucket(columns[0].view(np.uint64), columns[1].view(np.uint64), *columns[2:])
            out.write(data)
            rows.append((int(number), name, offset, len(data), len(columns[0])))
            offset += len(data)

        for b in batches:
            bucket = b.column(0).to_numpy()
            columns = [b.column(i).to_numpy() for i in range(1, 6)]
            for g in np.unique(bucket):
                if number is not None and number != g:
                    close()
                    held = []
                number = g
                here = bucket == g
                held.append([c[here] for c in columns])
        if number is not None:
            close()
            out.close()
            yield batch_of(rows, kind)

    filed = keys.select(F.pmod("h1", F.lit(buckets)).alias("bucket"), "h1", "h2", "first.shard", "first.ordinal", "n_docs")
    made, _ = stored(filed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, BUCKET), "buckets")
    by_number = {r.bucket: (r.file, r.offset, r.length) for r in made.collect()}
    return [by_number.get(i) for i in range(buckets)]


def round_trip(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents as shards, then look every key up in the index and read its documents back."""
    return TokenStore.write(docs, path, end_id, None, id_col, text_col).read(docs, id_col, ids=False)
