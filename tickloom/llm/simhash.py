"""SimHash fingerprints and their near-duplicate classes, by pigeonring filtering.

A fingerprint has a bit set where over half of the XXH64 values of the text's shingles have it. Two fingerprints are linked when they
differ in at most ``budget`` bits. The 64 bits form a ring of ``budget + 1`` segments. If two fingerprints are linked,
some segment starts a chain in which every run of ``l`` consecutive segments differs in at most
``l * budget / (budget + 1)`` bits (rounded down: 0, 1, 2, ...). So a fingerprint is filed under its first ``chain`` segments from every
start, and asks for every value of them within these budgets; the longer runs prune what meets, before the full distance.

Work is on distinct fingerprints, each standing for the smallest id that has it. Large groups of near copies would make
pairs with the square of their size, so links are found in two steps. First, in every bucket each fingerprint is compared with the
bucket's pivot (the one with most documents) only, and the components of those links are made. Second, pairs are compared in a bucket only between
different components, and members of a bucket's largest component only with the others in it: a link inside a component changes no class.
No link between components is lost, so the classes are those of all pairs. The plan is the same at every size.

Null text counts as empty: fingerprint zero, linked like any other. Texts of fewer words than a shingle are one shingle.
Repeated ids give repeated rows; a null id stays in its class and counts as no smallest id (a class of null ids only has the id null).
"""

from __future__ import annotations

import itertools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import discard, map_texts, stored

BITS = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16
#: Bits of each value of a byte, most significant first, and the place of each byte's counts.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
BYTE_AT = np.arange(8) * 256
#: Distinct fingerprints from which a third segment is filed: with two, chance meetings in a bucket outgrow the asks.
THIRD = 1 << 30
#: Parts that a class is read back in.
SALTS = 16


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    parts = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not parts:
        return 0
    whole = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size + 1) - 1
    begins = (ends - size)[:n].tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        h = [digest(whole[a:b], seed) for a, b in zip(begins[i : i + BLOCK], ends[i : i + BLOCK], strict=True)]
        each = np.array(h, ">u8").view(np.uint8).reshape(-1, 8) + BYTE_AT
        counts = np.bincount(each.ravel(), minlength=2048).reshape(8, 256)
        ones += (counts @ BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(
    df: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp) of every whole text; ``fp`` holds the 64 bits as a signed long."""

    def work(ids, texts):
        fps = np.array([fingerprint(t, words, seed) for t in texts], np.uint64).view(np.int64)
        return {"id": ids, "fp": fps.tolist()}

    return map_texts(df, id_col, text_col, "id bigint, fp bigint", work)


def segments(budget: int) -> list[int]:
    """Widths of the ring's segments."""
    n = budget + 1
    return [BITS // n + (i < BITS % n) for i in range(n)]


def run_budget(length: int, budget: int) -> int:
    return length * budget // (budget + 1)


def flips(widths: list[int], budget: int) -> list[int]:
    """Masks of a chain's bits (first segment highest) that keep every run from its start within budget."""
    masks = {0: 0}  # mask to bits set
    for length, width in enumerate(widths, 1):
        most = run_budget(length, budget)
        grown = {}
        for mask, held in masks.items():
            for n in range(most - held + 1):
                for bits in itertools.combinations(range(width), n):
                    grown[mask << width | sum(1 << b for b in bits)] = held + n
        masks = grown
    return sorted(masks)


def _turned(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by)) if by else fp


def _spread(value: Column, masks: list[int], n: int, start: int) -> Column:
    """The values that ``masks`` make of one; the number of the start in the lowest bits keeps the starts apart."""
    return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: value.bitwiseXOR(m.cast("bigint")) * n + start)


def _keys(budget: int, chain: int, near: bool) -> Column:
    """Bucket keys of column ``fp``: its own chain from every start, or all that lie within the budgets."""
    widths = segments(budget)
    n, keys, at = len(widths), [], 0
    for i in range(n):
        own = [widths[(i + j) % n] for j in range(chain)]
        value = F.shiftrightunsigned(_turned(F.col("fp"), at), BITS - sum(own))
        keys.append(_spread(value, flips(own, budget) if near else [0], n, i))
        at += widths[i]
    return F.concat(*keys)


def _in_budget(a: Column, b: Column, key: Column, budget: int, chain: int) -> Column:
    """Longer and longer runs from the key's start differ within their budgets, last the whole ring."""
    widths, n, at = segments(budget), budget + 1, 0
    by_start = []
    for i in range(n):
        x, held = _turned(a.bitwiseXOR(b), at), sum(widths[(i + j) % n] for j in range(chain))
        ok = F.lit(True)
        for length in range(chain + 1, n):
            held += widths[(i + length - 1) % n]
            ok = ok & (F.bit_count(F.shiftrightunsigned(x, BITS - held)) <= run_budget(length, budget))
        by_start.append((i, ok))
        at += widths[i]
    when = F.lit(False)
    for i, ok in by_start:
        when = F.when(F.pmod(key, F.lit(n)) == i, ok).otherwise(when)
    return when & (F.bit_count(a.bitwiseXOR(b)) <= budget)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``edges`` (a, b), for every node of an edge.

    Alternating large-star and small-star steps; each round is a table in the shared folder, the former one is deleted.
    """
    spark = edges.sparkSession
    now, path = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("b", "a")).alias("a"), F.col("m").alias("b"))
        nxt, new_path = stored(small.where("a <> b").distinct(), "edges")
        state = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        discard(spark, path)
        now, path = nxt, new_path
        if state == seen:
            break
        seen = state
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _links(distinct: DataFrame, budget: int, chain: int) -> DataFrame:
    """(fp, root) for every fingerprint whose root is another one, stored."""
    spark = distinct.sparkSession
    filed = distinct.select("fp", "n", F.explode(_keys(budget, chain, near=False)).alias("key"))
    shared = filed.groupBy("key").agg(F.count("*").alias("size"), F.max_by("fp", "n").alias("pivot")).where("size > 1").select("key", "pivot")
    shared, shared_path = stored(shared, "shared")
    # merge joins by hint: Spark would judge the sides by the compressed files they come from and broadcast large ones
    star = filed.join(shared.hint("merge"), "key").where((F.col("fp") != F.col("pivot")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= budget))
    rough, rough_path = stored(components(star.select(F.col("fp").alias("a"), F.col("pivot").alias("b"))).withColumnRenamed("node", "fp"), "rough")
    known, known_path = stored(distinct.join(rough.hint("merge"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("c")), "known")
    filed = known.select("fp", "c", F.explode(_keys(budget, chain, near=False)).alias("key"))
    asks = known.select("fp", "c", F.explode(_keys(budget, chain, near=True)).alias("key"))
    sizes = filed.join(shared.select("key").hint("merge"), "key").groupBy("key", "c").agg(F.count("*").alias("n"))
    main, main_path = stored(sizes.groupBy("key").agg(F.max(F.struct("n", "c")).alias("top")).select("key", F.col("top.c").alias("main")), "main")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c"))
    close = _in_budget(F.col("x.fp"), F.col("y.fp"), F.col("x.key"), budget, chain)
    # all ask for what is not of a bucket's largest component; what is not of that asks for it too
    rest = filed.join(main.hint("merge"), "key", "left").where("main IS NULL OR c <> main")
    others = asks.alias("x").join(rest.hint("merge").alias("y"), apart & close)
    strays = asks.join(main.hint("merge"), "key").where("c <> main")
    largest = filed.join(main.hint("merge"), "key").where("c = main")
    mains = strays.alias("x").join(largest.hint("merge").alias("y"), apart & close)
    met = [p.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")) for p in (others, mains)]
    fine = components(met[0].unionByName(met[1])).withColumnRenamed("node", "c").withColumnRenamed("root", "r")
    out = known.join(fine.hint("merge"), "c", "left").select("fp", F.coalesce("r", "c").alias("root"))
    out, _ = stored(out.where("fp <> root"), "classes")
    discard(spark, shared_path, rough_path, known_path, main_path)
    return out


def near_duplicates(
    df: DataFrame,
    words: int = 4,
    seed: int = 42,
    budget: int = 4,
    chain: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id of its class.

    ``chain`` changes the size of buckets only, not the classes: 2 files 26 bits and asks for 69 values, 3 files 39 bits and asks for
    1,370; by default 2, and 3 from ``THIRD`` distinct fingerprints on.
    """
    fps, _ = stored(fingerprints(df, words, seed, id_col, text_col), "fingerprints")
    distinct, distinct_path = stored(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    links = _links(distinct, budget, chain or (2 if distinct.count() < THIRD else 3))
    rooted = distinct.join(links.hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted, rooted_path = stored(rooted.withColumn("salt", F.pmod("fp", F.lit(SALTS))), "rooted")
    # a class of very many fingerprints is read back in parts
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    spread = smallest.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])))
    classes, _ = stored(rooted.join(spread.hint("merge"), ["root", "salt"]).select("fp", "component"), "components")
    discard(df.sparkSession, distinct_path, rooted_path)
    return fps.join(classes.hint("merge"), "fp").select("id", "fp", "component")
