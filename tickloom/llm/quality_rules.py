"""Learned decision lists over text statistics.

The statistics of a text are DataFrame expressions. A list is learned from labelled rows by sequential covering: a rule grows one
threshold at a time by information gain on two thirds of the rows, is pruned from its end on the other third, is kept if it is
precise enough there, and the rows that it covers leave both parts before the next rule. Rules are conjunctions that reject; the list
becomes one ordered conditional expression, whose last case keeps.

About ``sample_rows`` labelled rows (those of least hash of their id, so the same ones each time) come to the driver, as a few numbers
each; thresholds are tried at up to ``edges`` quantiles of a statistic. Statistics are computed of every whole text.

Null text has no words. Labels that are null are left out. Without labels of both kinds the list is empty and keeps all. Repeated rows pass through unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import hash_sample, text_of

#: White space between words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 3

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
FEATURES = {
    "n_words": "n_words",
    "word_size": "word_chars / n_words",
    "symbol_share": "n_symbols / word_chars",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "line_words": "n_words / n_lines",
}


def _repeated_words() -> Column:
    """Words in windows found twice or more, from ``_t``, the hashes of a text's windows.

    A window's hash and place are packed into one long (as many low bits as the places need) and sorted, so equal
    windows stand side by side; neighbours are then compared by the whole hash.
    """
    low = F.expr("shiftleft(1L, _bits)") - 1
    packed = F.transform("_t", lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint")))
    return F.sort_array(packed)


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the columns of ``STATISTICS`` (long), computed of a text column without nulls."""
    words = F.array_remove(F.split(F.col(text_col), SPACE), "")
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda x: x.rlike(WORD))
    df = df.withColumns({"_w": words, "_l": lines})
    df = df.withColumns({"n_words": F.size("_w").cast("bigint"), "_j": F.array_join("_w", "")})
    window = lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(WINDOW)])
    windows = F.when(
        F.size("_w") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), window)
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        *[c for c in df.columns if c not in ("_w", "_l", "_j")],
        F.char_length("_j").cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace("_j", NOT_SYMBOL, "")).cast("bigint").alias("n_symbols"),
        F.char_length(F.regexp_replace("_j", "[^A-Z]+", "")).cast("bigint").alias("n_upper"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("_t"),
    )
    # texts without a repeated window need no more work
    df = df.withColumn("_t", F.when(F.size(F.array_distinct("_t")) < F.size("_t"), F.col("_t")))
    df = df.withColumn("_bits", F.ceil(F.log2(F.size("_t") + F.lit(1))).cast("int"))
    df = df.withColumn("_s", F.when(F.col("_t").isNotNull(), _repeated_words()))
    low = F.expr("shiftleft(1L, _bits)") - 1
    place = lambda j: F.get("_s", j).bitwiseAND(low).cast("int")
    whole = lambda j: F.get("_t", place(j))
    near = lambda j, k: (
        F.coalesce(F.get("_s", j).bitwiseXOR(F.get("_s", k)) <= low, F.lit(False))
        & (F.get("_s", j).bitwiseXOR(F.get("_s", k)) >= 0)
        & (whole(j) == whole(k))
    )
    last = F.size("_s") - 1
    found = F.filter(F.sequence(F.lit(0), last), lambda j: ((j > 0) & near(j, j - 1)) | ((j < last) & near(j, j + 1)))
    df = df.withColumn("_p", F.when(F.col("_s").isNotNull(), F.sort_array(F.transform(found, place))))
    # each place covers the words up to the next place, at most a window
    ends = F.size("_p") - 1
    covered = F.when(
        F.size("_p") > 1,
        F.aggregate(
            F.sequence(F.lit(0), ends - 1), F.lit(0), lambda a, j: a + F.least(F.lit(WINDOW), F.get("_p", j + 1) - F.get("_p", j))
        ),
    ).otherwise(0)
    total = F.when(F.coalesce(F.size("_p"), F.lit(0)) > 0, covered + WINDOW).otherwise(0)
    df = df.withColumn("n_repeat_words", total.cast("bigint"))
    # through a generator, so that a filter on the statistics is not pushed down and does not compute them word by word
    kept = [f"`{c}`" for c in df.columns if c not in (*STATISTICS, "_t", "_bits", "_s", "_p")]
    return df.select(*kept, F.inline(F.array(F.struct(*STATISTICS))))


def feature(name: str) -> Column:
    """A feature of the statistics; 0 where it would divide by zero."""
    top, _, under = FEATURES[name].partition(" / ")
    return F.col(top).cast("double") if not under else F.when(F.col(under) > 0, F.col(top) / F.col(under)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = feature(self.feature)
        return x > self.threshold if self.above else x <= self.threshold

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        x = data[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(data) for c in self.conditions])

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def keeps(self) -> Column:
        """Ordered conditional expression over the statistics: false at the first rule that holds, else true."""
        out = None
        for rule in self.rules:
            out = F.when(rule.column(), False) if out is None else out.when(rule.column(), False)
        return F.lit(True) if out is None else out.otherwise(True)


def _counts(held: np.ndarray, bad: np.ndarray) -> tuple[int, int]:
    return int((held & bad).sum()), int((held & ~bad).sum())


def _grow(data: dict[str, np.ndarray], bad: np.ndarray, edges: dict[str, np.ndarray], most: int) -> list[Condition]:
    rule: list[Condition] = []
    held = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = _counts(held, bad)
        if not n0 or not p0:
            break
        best = (0.0, None)
        for name, values in edges.items():
            x = data[name][held]
            b = bad[held]
            order = np.argsort(x, kind="stable")
            up_to = np.searchsorted(x[order], values, side="right")
            p_low = np.concatenate([[0], np.cumsum(b[order])])[up_to]
            n_low = up_to - p_low
            for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))), 0.0)
                i = int(np.argmax(gain)) if len(gain) else -1
                if i >= 0 and gain[i] > best[0] + 1e-9:
                    best = (float(gain[i]), Condition(name, above, float(values[i])))
        if best[1] is None:
            break
        rule.append(best[1])
        held &= best[1].holds(data)
    return rule


def learn(
    data: dict[str, np.ndarray],
    bad: np.ndarray,
    pruning: np.ndarray,
    edges: int = 48,
    most_rules: int = 12,
    most_conditions: int = 4,
    precision: float = 0.95,
    least_covered: int = 5,
) -> DecisionList:
    """Sequential covering. ``pruning`` marks the rows that prune; the others grow."""
    cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, edges + 2)[1:-1])) for k, v in data.items() if len(v)}
    alive, rules = np.ones(len(bad), bool), []
    while len(rules) < most_rules:
        own = alive & ~pruning
        grown = _grow({k: v[own] for k, v in data.items()}, bad[own], cuts, most_conditions)
        if not grown:
            break
        test = alive & pruning
        held_out, held_bad = {k: v[test] for k, v in data.items()}, bad[test]
        scored = []
        for n in range(1, len(grown) + 1):
            p, q = _counts(Rule(tuple(grown[:n])).holds(held_out), held_bad)
            scored.append(((p - q) / (p + q) if p + q else -1.0, p, -n, p + q))
        worth, p, n, covered = max(scored)
        if covered < least_covered or p < precision * covered:
            break
        rule = Rule(tuple(grown[:-n]))
        rules.append(rule)
        alive &= ~rule.holds(data)
    return DecisionList(tuple(rules))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 8_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    **settings,
) -> DecisionList:
    """A list learned from ``labels`` (id, 1 good or 0 bad) of about ``sample_rows`` rows."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_good"))
    chosen = hash_sample(known.where("_id IS NOT NULL AND _good IS NOT NULL"), sample_rows, "_id")
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text"))
    rows = with_statistics(texts.join(F.broadcast(chosen), "_id")).select(
        "_good", (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(3)) == 0).alias("_prune"), *[feature(k).alias(k) for k in FEATURES]
    )
    got = sorted(rows.collect())
    if not got:
        return DecisionList(())
    good, prune, *columns = (np.array(c) for c in zip(*got, strict=True))
    data = dict(zip(FEATURES, columns, strict=True))
    return learn(data, good == 0, prune.astype(bool), **settings)


def base_failed(least_words: int = 50, most_repeated: int = 50) -> Column:
    """Too few words, or more than ``most_repeated`` percent of the words repeated."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def judge(df: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``df`` with the statistics and ``base_failed`` and ``kept``; the input's columns must not have their names."""
    out = with_statistics(df, text_col).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & rules.keeps())
