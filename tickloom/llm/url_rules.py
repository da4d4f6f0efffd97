"""Allow and block rules for urls, joined by a sorted sweep over key ranges.

A host's key is its labels from last to first, each followed by ``/`` (no host holds one), so a host and all its
subdomains are one range of keys, and ranges of rules are nested or apart. Urls and rules are cut into parts at sampled
keys, a rule going to every part that its range touches, and each part is swept in key order with a stack of the rules
whose ranges are open. Among the open rules those fit whose path starts the url's path; the one with the most characters in host
and path wins, of equal ones that with the longer host.

Cuts are (key, hash of the id), so a key with any share of the rows is spread over parts. They come from
about ``SAMPLE`` rows of least hash, whatever the table holds; cuts move work between tasks and never change a verdict.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; the path goes on
to ``?``, ``#`` or the end. Null urls and those without ``://`` have both empty, so only rules of the empty host and path could fit. Rules with a
null host or path are left out; of rules with the same host and path the one with the greater verdict stands. Repeated rows pass through.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_schema, batch_of, hash_sample

#: Keys that the cuts are taken from, about.
SAMPLE = 4_096
#: Parts for each shuffle partition.
PARTS = 4
SWEPT = "part bigint, key string, is_url boolean, id bigint, host string, path string, verdict string"
JUDGED = "id bigint, host string, path string, rule string, verdict string"


def host_key(host: str) -> str:
    """``www.example.com`` as ``com/example/www/``; the empty host as the empty key, the start of all."""
    return "".join(f"{x}/" for x in reversed(host.split("."))) if host else ""


def with_host_and_path(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Columns ``host`` and ``path`` of the urls."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return df.withColumns(
        {"host": F.translate(host, up, low), "path": F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)}
    )


def _key(host: str) -> F.Column:
    """``host_key`` of a column."""
    labels = F.reverse(F.split(F.col(host), r"\.", -1))
    return F.when(F.col(host) == "", "").otherwise(F.concat(F.array_join(labels, "/"), F.lit("/")))


def _sweep(batches, default: str, kind: pa.Schema):
    now, stack = None, []  # open ranges: (key, host, {path length: {path: verdict}})
    for batch in batches:
        rows = []
        for part, key, is_url, id_, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != now:
                now, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}))
                same = stack[-1][2].setdefault(len(path), {})
                same[path] = max(verdict, same.get(path, verdict))
                continue
            best = (-1, -1, None, default)
            for _, rule_host, paths in stack:
                for size, by_path in paths.items():
                    if (found := by_path.get(path[:size])) is not None:
                        best = max(best, (len(rule_host) + size, len(rule_host), rule_host + path[:size], found))
            rows.append((id_, host, path, best[2], best[3]))
        if rows:
            yield batch_of(rows, kind)


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every url. ``rules`` has (host, path, verdict)."""
    spark = urls.sparkSession
    parsed = with_host_and_path(urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")))
    keyed = parsed.select("id", "host", "path", F.concat(_key("host"), "path").alias("key"), F.xxhash64("id").alias("salt"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * PARTS
    sample = sorted((r.key, r.salt) for r in hash_sample(keyed.select("key", "salt"), SAMPLE, "key", "salt").collect())
    cuts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []
    names = [f.split()[0] for f in SWEPT.split(", ")]
    kind, judged = arrow_schema(SWEPT), arrow_schema(JUDGED)

    def place_urls(batches):
        for b in batches:
            at = [bisect.bisect_right(cuts, k) for k in zip(b["key"].to_pylist(), b["salt"].to_pylist(), strict=True)]
            n = len(at)
            none = pa.nulls(n, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), b["key"], pa.array([True] * n), b["id"], b["host"], b["path"], none], schema=kind
            )

    def place_rules(batches):
        for b in batches:
            for host, path, verdict in zip(*(b[c].to_pylist() for c in ("host", "path", "verdict")), strict=True):
                key = host_key(host)
                # first cut beyond the range's begin to first cut beyond its end
                first = bisect.bisect_right(cuts, (key, -(2**63)))
                last = bisect.bisect_left(cuts, (key + "\U0010ffff\U0010ffff",))
                yield batch_of([(part, key, False, None, host, path, verdict) for part in range(first, last + 1)], kind)

    placed = keyed.mapInArrow(place_urls, SWEPT).unionByName(
        rules.select("host", "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL").mapInArrow(place_rules, SWEPT)
    )
    swept = placed.repartition(max(1, parts // PARTS), "part").sortWithinPartitions("part", "key", "is_url").select(*names)
    return swept.mapInArrow(lambda batches: _sweep(batches, default, judged), JUDGED)
