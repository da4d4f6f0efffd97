"""Near copies of texts by the Jaccard similarity of their word shingles.

A text is the set of its shingles of ``words`` words (lower-cased, ASCII white space splits; fewer words are one shingle). MinHash bands
put sets into buckets: two sets of similarity 0.8 share one of 25 bands of 5 values with probability 0.99995, and of more similarity more
surely. Sets are linked if the exact similarity of the whole sets is at least ``least``; the classes are the components of the links.

Work is on distinct sets, and no step makes all pairs of a bucket:

1. In rounds, every bucket with several components compares the sets outside its largest component with a few sets of that (``PIVOTS``, by
   hash). That is linear in the bucket, and what has many near copies is soon linked. Classes do not depend on the rounds.
2. Sets that are still outside some bucket's largest component are compared by prefix filtering, which misses no pair: shingles are ordered by
   how many sets have them, rarest first. If two sets are similar enough, they share a shingle of the larger's first (1 - t) of its size and the
   smaller's first (1 - 2t / (1 + t)), and behind their first shared one enough is left in both. Texts that share one long passage and differ in a
   tenth or more have only rare shingles there, so a group just below the limit makes no pairs. Sizes, components and places are compared in the join.

Sets of buckets are made once and read for pairs that passed the filters only. Null text counts as empty, and empty texts are alike. Rows with a null
id are left out. A very long text is one row with its shingles. Repeated rows are in one class; other texts under a repeated id are sets of their own.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import discard, map_texts, stored
from tickloom.llm.simhash import components

BANDS = 25
ROWS = 5
#: Sets of a bucket's largest component that the others are compared with, in each round before the prefix filter; no class depends on it.
PIVOTS = (1, 6)
#: Parts that a class is read back in.
SALTS = 16
#: Shingles that one step multiplies at once.
BLOCK = 1 << 12
_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    parts = text.encode().lower().split()
    n = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(parts[i : i + words])) for i in range(n)), np.uint64, n))


def bands(held: np.ndarray) -> list[int]:
    """One key for each band of the least products of a set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(held), BLOCK):
        least = np.minimum(least, (held[None, i : i + BLOCK] * _FACTORS).min(axis=1))
    raw = least.tobytes()
    width = 8 * ROWS
    return [_signed(xxhash.xxh64_intdigest(raw[b * width : (b + 1) * width], b)) for b in range(BANDS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame, str]:
    """The pairs (a, b) whose whole sets are similar enough, stored."""
    x, y = sets.select(F.col("t").alias("a"), F.col("held").alias("x")), sets.select(F.col("t").alias("b"), F.col("held").alias("y"))
    met = pairs.distinct().join(x.hint("merge"), "a").join(y.hint("merge"), "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return stored(met.where(F.col("common") >= least * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b"), "alike")


def _state(full: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, t, c, main): the component of every set of a bucket and the bucket's largest one, where there are several."""
    known = full.withColumn("c", F.col("t"))
    if roots is not None:
        known = full.join(roots.hint("merge"), "t", "left").select("key", "t", F.coalesce("root", "t").alias("c"))
    sizes = known.groupBy("key", "c").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "c")).alias("top"), F.count("*").alias("several")).where("several > 1")
    return known.join(main.select("key", F.col("top.c").alias("main")).hint("merge"), "key")


def prefixes(sets: DataFrame, least: float) -> DataFrame:
    """(t, size, x, at): the rarest shingles of each set that a similar set must share one of, with their places."""
    each = sets.select("t", F.size("held").alias("size"), F.explode("held").alias("x"))
    held_by = each.groupBy("x").agg(F.count("*").alias("df"))
    ordered = each.join(held_by.hint("merge"), "x").groupBy("t", "size").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("all"))
    reach = F.col("size") - F.ceil(least * F.col("size") - 1e-9) + 1
    first = ordered.select("t", "size", F.slice("all", F.lit(1), reach.cast("int")).alias("first"))
    return first.select("t", "size", F.posexplode("first").alias("at", "one")).select("t", "size", F.col("one.x").alias("x"), "at")


def _candidates(outside: DataFrame, inside: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of a set outside and any other, of different components, that pass the prefix, size and place filters."""
    short = F.col("at") <= F.col("size") - F.ceil(2 * least / (1 + least) * F.col("size") - 1e-9)
    out = None
    for small, large in ((outside, inside), (inside, outside)):
        x, y = small.where(short).alias("x"), large.alias("y")
        left = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))  # from the shared shingle on
        fits = (F.col("x.size") <= F.col("y.size")) & (F.col("x.size") >= least * F.col("y.size") - 1e-9)
        enough = left >= least / (1 + least) * (F.col("x.size") + F.col("y.size")) - 1e-9
        met = x.join(y.hint("merge"), (F.col("x.x") == F.col("y.x")) & (F.col("x.c") != F.col("y.c")) & fits & enough)
        met = met.select(F.least("x.t", "y.t").alias("a"), F.greatest("x.t", "y.t").alias("b"))
        out = met if out is None else out.unionByName(met)
    return out.distinct()


def near_copies(df: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component): every row with an id, and the smallest id of its class."""
    spark = df.sparkSession
    df = df.where(F.col(id_col).isNotNull())

    def sign(ids, texts):
        sets = [shingles(x, words) for x in texts]
        return {"id": ids, "t": [_signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets], "keys": [bands(s) for s in sets]}

    def spell(ids, texts):
        sets = [shingles(x, words) for x in texts]
        return {"id": ids, "t": [_signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets], "held": [s.view(np.int64).tolist() for s in sets]}

    signed, _ = stored(map_texts(df, id_col, text_col, "id bigint, t bigint, keys array<bigint>", sign), "signed")
    nodes, nodes_path = stored(signed.groupBy("t").agg(F.min("id").alias("first_id"), F.first("keys").alias("keys")), "nodes")
    filed = nodes.select("t", F.explode("keys").alias("key"))
    buckets = filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    full, full_path = stored(filed.join(buckets.hint("merge"), "key"), "buckets")
    members = nodes.join(full.select("t").distinct().hint("merge"), "t", "left_semi").select("t", "first_id")
    texts = df.join(members.select("first_id").distinct().hint("merge"), F.col(id_col) == F.col("first_id"), "left_semi")
    sets = map_texts(texts, id_col, text_col, "id bigint, t bigint, held array<bigint>", spell)
    # of repeated rows one; other texts under a repeated id are other nodes
    sets = sets.join(members.hint("merge"), "t").where("id = first_id").groupBy("t").agg(F.first("held").alias("held"))
    sets, sets_path = stored(sets, "sets")

    paths, links, roots, state = [nodes_path, full_path, sets_path], None, None, None
    for turn, several in enumerate(PIVOTS):
        state, path = stored(_state(full, roots), "state")
        paths.append(path)
        few = F.array_distinct(F.array(*[F.min_by("t", F.xxhash64("t", F.lit(8 * turn + i))) for i in range(several)]))
        pivots = state.where("c = main").groupBy("key").agg(few.alias("few")).select("key", F.explode("few").alias("pivot"))
        outside = state.where("c <> main").join(pivots.hint("merge"), "key")
        found, path = _alike(outside.select(F.col("pivot").alias("a"), F.col("t").alias("b")), sets, least)
        paths.append(path)
        links = found if links is None else links.unionByName(found)
        roots, path = stored(components(links).withColumnRenamed("node", "t"), "roots")
        paths.append(path)
    state, path = stored(_state(full, roots), "state")
    paths.append(path)
    parts = state.groupBy("t", "c").agg(F.max(F.col("c") != F.col("main")).alias("out"))
    mixed = sets.join(parts.select("t").hint("merge"), "t", "left_semi")
    first, path = stored(prefixes(mixed, least).join(parts.hint("merge"), "t"), "prefixes")
    paths.append(path)
    more, path = _alike(_candidates(first.where("out"), first, least), sets, least)
    paths.append(path)
    links = links.unionByName(more)

    # a class of very many sets is read back in parts; sets without a link are classes of their own
    roots, path = stored(components(links).withColumnRenamed("node", "t"), "roots")
    paths.append(path)
    linked = nodes.join(roots.hint("merge"), "t", "left").select("t", "first_id", "root", F.pmod("t", F.lit(SALTS)).alias("salt"))
    alone = linked.where("root IS NULL").select("t", F.col("first_id").alias("component"))
    smallest = linked.where("root IS NOT NULL").groupBy("root").agg(F.min("first_id").alias("component"))
    spread = smallest.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])))
    joined = linked.join(spread.hint("merge"), ["root", "salt"]).select("t", "component")
    classes, _ = stored(joined.unionByName(alone), "classes")
    discard(spark, *paths)
    return signed.join(classes.hint("merge"), "t").select("id", "component")
