"""Merkle manifest of a dataset, with inclusion proofs by nested-interval labels.

A row's leaf is the digest H (SHA-256 of the texts joined, as lower-case hex) of its named columns, each written as ``-`` if null, else as UTF-8 byte
count, colon and value. In every group the leaves ascend by the order column (nulls first, ties by leaf); every ``arity`` neighbours (the
last run: fewer, even one) become the H of their digests, level by level, until one node remains, the group's subroot; a lone leaf is its
own. The subroots, ordered by group (null first, by UTF-8 bytes), become the root in the same way.

Every node is labelled with the interval of leaf ranks that it covers, [lo, hi). A node's ancestor at a level is found by containment: both sides
are bucketed by level and by the start of the interval that this level has there, so the join is one of equality whose condition checks that the
interval holds the node. The siblings are what the parent's interval has besides the node: its children that end before it, then those that start behind.

Levels go in bands of ``BAND`` leaves (8 levels for pairs). A block of one band is one row of at most ``BAND`` digests and is hashed up inside it; the
blocks' tops are the leaves of the next band. So rows take part in one band of joins, not in a join for every level of the whole tree, and
what lies above is attached to their block: work and shuffle are in proportion to the rows. Ranks come from one range sort by (group, order, leaf), so a group
of any share of the rows is spread over tasks, and from counts by (group, task).

Repeated rows are leaves of their own, side by side. An empty table has no groups, no root and no proofs. Columns that are not named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import discard, stored

#: Most leaves of a block.
BAND = 256


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def written(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return digest(*[written(c) for c in columns])


def _powers(arity: int) -> list[int]:
    out = [1]
    while out[-1] * arity < 1 << 62:
        out.append(out[-1] * arity)
    return out


def ranked(leaves: DataFrame, arity: int) -> tuple[DataFrame, list[str]]:
    """``leaves`` (g, o, digest, ...) with rank ``r`` and count ``n`` in their group and the height ``h`` of its tree, stored."""
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves, path = stored(leaves.withColumn("src", F.spark_partition_id()), "leaves")
    # the task a row came from comes last: rows that are equal in all else are spread as well
    order = [F.col("g"), F.col("o").asc_nulls_first(), F.col("digest"), F.col("src")]
    ranged = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("src")
    placed, placed_path = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("task", F.shiftright("place", 33))
    starts = placed.groupBy("g", "task").agg(F.min("place").alias("first"), F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy("g").orderBy("task")) - F.col("held")
    starts = starts.select("g", "task", (before - F.col("first")).alias("shift"), F.sum("held").over(Window.partitionBy("g")).alias("n"))
    height = F.size(F.filter(F.array(*[F.lit(p) for p in _powers(arity)]), lambda p: p < F.col("n")))
    starts, starts_path = stored(starts.withColumn("h", height), "starts")
    # one row for each group and task that has some of it: broadcast only if Spark finds the stored table small
    return placed.join(starts, ["g", "task"]).withColumn("r", F.col("place") + F.col("shift")).drop("place", "task", "shift"), [path, placed_path, starts_path]


class Tree:
    """The trees of all groups, in bands. ``bands``: rows (g, block, n, h, levels); ``tops``: (g, n, h, top)."""

    def __init__(self, leaves: DataFrame, arity: int = 2):
        if not 2 <= arity <= BAND:
            raise ValueError(f"a node has 2 to {BAND} children")
        self.arity, self.powers = arity, _powers(arity)
        self.steps = max(k for k in range(1, 9) if arity**k <= BAND)
        self.width = arity**self.steps
        self.spark = leaves.sparkSession
        self.leaves, self.paths = ranked(leaves, arity)
        self.bands: list[DataFrame] = []
        now = self.leaves.select("g", "r", "digest", "n", "h")
        highest = self.leaves.agg(F.max("h")).first()[0] or 0
        for low in range(0, max(1, highest), self.steps):
            blocks = now.groupBy("g", F.floor(F.col("r") / self.width).alias("block")).agg(
                F.first("n").alias("n"), F.first("h").alias("h"), F.sort_array(F.collect_list(F.struct("r", "digest"))).alias("held")
            )
            held, path = stored(blocks.select("g", "block", "n", "h", self._levels(low).alias("levels")), "band")
            self.paths.append(path)
            self.bands.append(held)
            now = held.where(F.col("h") > low + self.steps).select("g", F.col("block").alias("r"), F.element_at("levels", -1)[0].alias("digest"), "n", "h")
        self.tops = None
        for b, held in enumerate(self.bands):
            low = b * self.steps
            done = held.where((F.col("h") <= low + self.steps) & ((F.col("h") > low) | F.lit(b == 0)))
            done = done.select("g", "n", "h", F.element_at("levels", -1)[0].alias("top"))
            self.tops = done if self.tops is None else self.tops.unionByName(done)

    def _count(self, low: int) -> Column:
        """Levels of a block whose leaves lie at level ``low``."""
        return F.least(F.lit(self.steps), F.col("h") - low)

    def _levels(self, low: int) -> Column:
        """The digests of a block's nodes, an array for every level from its leaves up."""
        arity, own = self.arity, F.transform("held", lambda x: x["digest"])

        def up(levels, _):
            last = F.element_at(levels, -1)
            runs = F.sequence(F.lit(0), F.floor((F.size(last) - 1) / arity).cast("int"))
            return F.concat(levels, F.array(F.transform(runs, lambda j: F.sha2(F.array_join(F.slice(last, j * arity + 1, arity), ""), 256))))

        count = self._count(low)
        return F.when(count > 0, F.aggregate(F.sequence(F.lit(1), count), F.array(own), up)).otherwise(F.array(own))

    def parents(self, band: int) -> DataFrame:
        """(g, level, lo, hi, digest, kids) of the nodes above a band's leaves; kids are (lo, hi, digest)."""
        low, arity = band * self.steps, self.arity
        spans = F.array(*[F.lit(p) for p in self.powers[low : low + self.steps + 1]])
        begin, n = F.col("block") * self.powers[low] * self.width, F.col("n")

        def interval(at, span):
            lo = begin + at.cast("bigint") * span
            return lo.alias("lo"), F.least(lo + span, n).alias("hi")

        def level(i):
            span, under = F.element_at(spans, i + 1), F.element_at(spans, i)

            def node(x, k):
                kids = F.transform(F.slice(F.element_at("levels", i), k * arity + 1, arity), lambda y, m: F.struct(*interval(k * arity + m, under), y.alias("digest")))
                return F.struct((i + low).alias("level"), *interval(k, span), x.alias("digest"), kids.alias("kids"))

            return F.transform(F.element_at("levels", i + 1), node)

        rows = self.bands[band].where(F.size("levels") > 1)
        return rows.select("g", F.inline(F.flatten(F.transform(F.sequence(F.lit(1), F.size("levels") - 1), level))))

    def nodes(self) -> DataFrame:
        """(g, level, lo, hi, digest) of every node above the leaves."""
        out = None
        for b in range(len(self.bands)):
            part = self.parents(b).drop("kids")
            out = part if out is None else out.unionByName(part)
        return out

    def _steps_up(self, rows: DataFrame, band: int) -> DataFrame:
        """(g, block, r, step) for each row (g, r, h) of a band's leaves and each level of the band: the parent's children before and behind."""
        low = band * self.steps
        span = F.array(*[F.lit(p) for p in self.powers[low : low + self.steps + 1]])
        levels = F.sequence(F.lit(low + 1), F.col("h").cast("int")) if band == len(self.bands) - 1 else F.sequence(F.lit(low + 1), F.least(F.col("h"), F.lit(low + self.steps)))
        asked = rows.where(F.col("h") > low).select("g", "r", (F.col("r") * self.powers[low]).alias("at"), F.explode(levels).alias("level"))
        size = F.element_at(span, F.col("level") - low + 1)
        asked = asked.withColumn("bucket", F.floor(F.col("at") / size) * size)
        held = self.parents(band).select(F.col("g").alias("pg"), F.col("level").alias("pl"), "lo", "hi", "kids")
        inside = (F.col("lo") <= F.col("at")) & (F.col("at") < F.col("hi"))
        met = asked.join(held.hint("merge"), (F.col("g") == F.col("pg")) & (F.col("level") == F.col("pl")) & (F.col("bucket") == F.col("lo")) & inside)

        def side(keep):
            return F.array_join(F.transform(F.filter("kids", keep), lambda k: k["digest"]), "")

        step = F.struct("level", side(lambda k: k["hi"] <= F.col("at")).alias("left"), side(lambda k: k["lo"] > F.col("at")).alias("right"))
        return met.select("g", F.floor(F.col("r") / self.width).alias("block"), "r", step.alias("step"))

    def with_path(self) -> DataFrame:
        """The leaves with ``path``: from the leaf's siblings up, the digests before and behind at every level."""
        above = None
        for b in reversed(range(1, len(self.bands))):
            low = self.bands[b - 1].where(F.col("h") > b * self.steps).select("g", F.col("block").alias("r"), "h")
            found = self._steps_up(low, b).groupBy("g", "block", "r").agg(F.sort_array(F.collect_list("step")).alias("path"))
            if above is not None:
                found = found.join(above.hint("merge"), ["g", "block"], "left").select("g", "r", F.concat("path", F.coalesce("over", F.array())).alias("path"))
            above, path = stored(found.select("g", F.col("r").alias("block"), F.col("path").alias("over")), "above")
            self.paths.append(path)
        steps = self._steps_up(self.leaves.select("g", "r", "h"), 0)
        row = F.struct(*[c for c in self.leaves.columns if c not in ("g", "r")])
        rows = self.leaves.select("g", F.floor(F.col("r") / self.width).alias("block"), "r", row.alias("row"))
        both = steps.unionByName(rows, allowMissingColumns=True).repartition("g", "block")
        met = both.groupBy("g", "block", "r").agg(F.sort_array(F.collect_list("step")).alias("path"), F.first("row", ignorenulls=True).alias("row"))
        if above is not None:
            met = met.join(above.hint("merge"), ["g", "block"], "left").withColumn("path", F.concat("path", F.coalesce("over", F.array())))
        return met.select("g", "r", "row.*", "path")

    def drop(self) -> None:
        """Delete the tree's tables; what was made of it must have been written."""
        discard(self.spark, *self.paths)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf has by a path."""
    return F.aggregate(path, leaf, lambda held, x: digest(x["left"], held, x["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def manifest(df: DataFrame, columns: list[str], group: str, order: str, arity: int = 2, keep: dict[str, Column] | None = None) -> DataFrame:
    """(id, group_key, rank, leaf, subroot, root, path, *keep) of every row.

    ``path`` leads from the leaf over the subroot to the root. ``keep`` names further columns, made from those of ``df``.
    """
    keep = keep or {}
    if clash := {"g", "r", "o", "digest", "src", "place", "task", "shift", "first", "n", "h", "row", "path"} & set(keep):
        raise ValueError(f"the names {sorted(clash)} are the operator's own")
    key = F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit(""))
    rows = df.select(key.alias("g"), F.col(order).alias("o"), leaf_of(*map(F.col, columns)).alias("digest"), *[c.alias(n) for n, c in keep.items()])
    tree = Tree(rows, arity)
    tops = Tree(tree.tops.select(F.lit("").alias("g"), F.col("g").alias("o"), F.col("top").alias("digest")), arity)
    root = tops.tops.select("g", F.col("top").alias("root"))
    over = tops.with_path().join(root, "g").select(F.col("o").alias("g"), F.col("digest").alias("subroot"), F.col("path").alias("over"), "root")
    over, _ = stored(over, "over")
    # one row for each group: broadcast only if Spark finds the stored table small
    met = tree.with_path().join(over, "g")
    return met.select(F.col("o").alias("id"), F.col("g").alias("group_key"), F.col("r").alias("rank"), F.col("digest").alias("leaf"), "subroot", "root", F.concat("path", "over").alias("path"), *keep)
