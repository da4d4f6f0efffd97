"""Document fingerprints from closed syncmers.

A text is read as pieces between ASCII white space: words of at most ``PIECE`` characters; of longer runs, and of scripts that
are written without spaces, each character is a piece (a character repeated up to ``PIECE`` times is one piece), so that no piece
but of one repeated character depends on where its run began. Of every k consecutive pieces all runs of s pieces
are hashed; the k-mer is an anchor if its least inner hash lies at either edge. Whether a k-mer is an anchor depends on
nothing but itself, so an edit changes only the anchors that touch it. The fingerprint is the sorted list of all the distinct
anchors' 32-bit hashes, eight hex digits each; texts with fewer pieces than k have all their pieces as the one anchor. The likeness
of two fingerprints is the Jaccard similarity of these sets. Two empty fingerprints are alike. ``anchors`` gives the places too.

Only DataFrame functions are used. Null text counts as empty (fingerprint empty).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import text_of

PIECE = 24
_BLANK = r"\x20\x09-\x0D"
_UNSPACED = "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
_SPACED = f"[^{_BLANK}{_UNSPACED}]"
_PIECES = rf"(?<!{_SPACED}){_SPACED}{{1,{PIECE}}}+(?!{_SPACED})|([^{_BLANK}])\1{{0,{PIECE - 1}}}"
#: Ranges of ids for each shuffle partition.
RANGES = 4


def _with_anchor_places(df: DataFrame, text_col: str, k: int, s: int) -> DataFrame:
    """Adds ``_h`` (hash of each piece) and ``_at`` (index of the first piece of each anchor)."""
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(_PIECES), F.lit(0))
    df = df.withColumn("_h", F.transform(pieces, lambda w: F.xxhash64(w)))
    inner = F.transform(
        F.sequence(F.lit(0), F.size("_h") - s), lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(s)])
    )
    df = df.withColumn("_inner", F.when(F.size("_h") >= k, inner))
    last = k - s  # inner runs of a k-mer begin at 0..last
    edge = lambda i: F.least(F.get("_inner", i), F.get("_inner", i + last)) <= F.least(
        *[F.get("_inner", i + j) for j in range(1, last)]
    )
    places = F.filter(F.sequence(F.lit(0), F.size("_h") - k), edge)
    return df.withColumn("_at", F.when(F.size("_h") >= k, places)).drop("_inner")


def _kmer(i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get("_h", i + j) for j in range(k)])


def _short(h: Column) -> Column:
    """The upper half of a hash."""
    return F.shiftright(h, 32).cast("int")


def anchors(df: DataFrame, k: int = 5, s: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, position, hash): the anchors of every text by the number of their first piece."""
    narrow = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("_t"))
    placed = _with_anchor_places(narrow, "_t", k, s)
    return placed.select("id", "_h", F.explode("_at").alias("position")).select("id", "position", _kmer(F.col("position"), k).alias("hash"))


def with_sketch(df: DataFrame, text_col: str, out: str, k: int = 5, s: int = 2) -> DataFrame:
    """Adds the sorted array of all distinct 32-bit anchor hashes of a text column without nulls."""
    if not 1 <= s < k - 1:
        raise ValueError("k must exceed s by two at least")
    placed = _with_anchor_places(df, text_col, k, s)
    short = F.when(F.size("_h") == 0, F.array().cast("array<int>")).otherwise(F.array(_short(F.xxhash64("_h"))))
    every = F.sort_array(F.array_distinct(F.transform("_at", lambda i: _short(_kmer(i, k)))))
    return placed.withColumn(out, F.when(F.size("_h") < k, short).otherwise(every)).drop("_h", "_at")


def said(sketch: str) -> Column:
    """A sketch as hex digits, eight for each value."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sketches, 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, 1.0).otherwise(common / F.greatest(union, F.lit(1)))


def _range_of(column: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` lie above the value (0 is the highest range; null is the last)."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    down = sorted(cuts, reverse=True)
    coarse, fine = F.array(*[F.lit(c) for c in down[::step]]), F.array(*[F.lit(c) for c in down])
    # whole steps whose first cut lies above the value, then the cuts of the last of them
    whole = F.greatest(F.size(F.filter(coarse, lambda c: c > column)) - 1, F.lit(0)) * step
    rest = F.size(F.filter(F.slice(fine, whole + 1, step), lambda c: c > column))
    return F.when(column.isNull(), len(cuts)).otherwise(whole + rest)


def with_next(df: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for each carried column: the value in the next row by falling id, in the last row that of the first.

    Rows are dealt into ranges of ids at approximate quantiles. The first row of each range is also sent to the
    range above it, where it follows the last row, and the first of all to the last range. Rows of one id are ordered by a hash
    of what they carry; null ids come last. A single row follows itself.
    """
    spark = df.sparkSession
    ids = df.select(F.col(id_col).cast("bigint").alias("id"))
    wanted = max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * RANGES
    marks = ids.agg(F.percentile_approx("id", [i / wanted for i in range(1, wanted)], 100 * wanted)).first()[0] if wanted > 1 else []
    cuts = sorted(set(marks or []))
    own = _range_of(F.col("id"), cuts)
    # one row per range, at most ``wanted`` of them
    tops = ids.groupBy(own.alias("range")).agg(F.max("id").alias("top")).orderBy("range").collect()
    follow = [(tops[(i + 1) % len(tops)].top, tops[i].range) for i in range(len(tops))]
    copies = F.broadcast(spark.createDataFrame(follow or [(None, 0)], "top bigint, copy int").where(F.lit(bool(follow))))
    gathered = copies.groupBy("top").agg(F.collect_list("copy").alias("copies"))
    keyed = df.withColumn("_id", F.col(id_col).cast("bigint"))
    keyed = keyed.withColumn("_own", _range_of(F.col("_id"), cuts))
    sent = keyed.join(F.broadcast(gathered), keyed["_id"].eqNullSafe(gathered["top"]), "left").drop("top")
    to = F.array_union(F.array(F.struct(F.lit(0).alias("halo"), F.col("_own").alias("range"))),
                       F.transform(F.coalesce("copies", F.array().cast("array<int>")), lambda c: F.struct(F.lit(1).alias("halo"), c.alias("range"))))
    spread = sent.withColumn("_to", F.explode(to)).withColumns({"_halo": F.col("_to.halo"), "_range": F.col("_to.range")})
    from pyspark.sql import Window

    order = Window.partitionBy("_range").orderBy("_halo", F.col("_id").desc_nulls_last(), F.xxhash64(*carried))
    followed = spread.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return followed.where("_halo = 0").drop("_id", "_own", "copies", "_to", "_halo", "_range")


def compare_edits(
    df: DataFrame, k: int = 5, s: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every whole text.

    The edited text has its last half replaced by the first half's length of the next text by falling id.
    """
    texts = with_sketch(df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), "text", "sketch", k, s)
    pairs = with_next(texts, "id", ["text", "sketch"]).withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("next_text").substr(F.lit(1), half)
    )
    pairs = pairs.select("id", "n_chars", "sketch", "next_sketch", edited.alias("edited"))
    both = with_sketch(pairs, "edited", "edited_sketch", k, s)
    return both.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        said("sketch").alias("fingerprint"),
        said("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
    )
