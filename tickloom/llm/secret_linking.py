"""Secrets in texts, with credentials linked over their parts.

Base patterns are reported wherever they match: assignments to secret-like names, access identifiers and long runs of
hexadecimal digits. Other parts say little alone: identifiers (user, client or account names that are assigned),
secret-like strings and endpoints. They are weak candidates. Every identifier and secret opens a scope: ``reach``
characters to either side, cut off at blank lines. An interval join finds what else lies in a scope, and a weak candidate is
reported only when the parts that complete it are there:

* a secret-like string needs an access identifier, or an assigned identifier and an endpoint;
* an assigned identifier needs a secret (base or secret-like), and an endpoint unless the secret is a base one;
* an endpoint needs an identifier and a secret.

The join sorts the parts of a step by place and asks by binary search whether a kind has a part that begins within a scope and
ends in it, so its work is that of sorting, however many parts a text holds. A secret-like string has 20 signs or more, a digit and a
lower-case letter; strings without these are no candidates, however long.

Null text counts as empty and has no spans; ids and repeated rows pass through unchanged. Places are code points, ends
are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_texts

ASSIGN, ACCESS, HEX, SECRET, IDENTIFIER, ENDPOINT = KINDS = ("assign", "access", "hex", "secret", "identifier", "endpoint")

#: The base patterns; group 2 of the first holds the value.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

# weak parts: a string of 20 signs at least with a digit and a lower-case letter, an assigned name, an address
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
_IDENTIFIER = re.compile(
    r"""\b(?:user(?:name)?|login|account(?:_?id)?|client_?id|access_?key_?id|tenant(?:_?id)?)["']?[ ]*[:=][ ]*["']?([A-Za-z0-9@_.+-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
_ENDPOINT = re.compile(
    r"""\b(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,}|(?:host|endpoint|server|url)["']?[ ]*[:=][ ]*["']?[A-Za-z0-9.-]+\.[A-Za-z]{2,}[^\s"'<>]*)""",
    re.IGNORECASE | re.ASCII,
)
_BLANK = re.compile(r"\n[ \t\r]*\n")

SPAN = "struct<kind: string, start: bigint, end: bigint>"


def base_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, number of the kind, end); failing matches are dropped but keep what they cover."""
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= LEAST_VALUE:
            yield m.start(), 0, m.end()
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST_ACCESS:
            yield m.start(), 1, m.end()
    for m in _HEX.finditer(text):
        yield m.start(), 2, m.end()


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Parts that need others; secret-like strings that touch a base span are that span."""
    starts = sorted(s for s, _, _ in base)
    ends = sorted(e for _, _, e in base)
    if not base and not _IDENTIFIER.search(text):
        return  # every rule needs a base part or an assigned identifier
    for m in _SECRET.finditer(text):
        if bisect_left(starts, m.end()) == bisect_right(ends, m.start()):
            yield m.start(), 3, m.end()
    for m in _IDENTIFIER.finditer(text):
        yield m.start(), 4, m.end()
    for m in _ENDPOINT.finditer(text):
        yield m.start(), 5, m.end()


class _Parts:
    """Spans of some kinds, ready to be asked whether a scope wholly holds one."""

    def __init__(self, start: np.ndarray, end: np.ndarray):
        order = np.argsort(start, kind="stable")
        self.start = start[order]
        # least end of the spans from each on: a scope holds a part if one that begins in it ends in it
        self.end = np.minimum.accumulate(end[order][::-1])[::-1]

    def within(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.start, low)
        held = np.append(self.end, np.iinfo(np.int64).max)[at]
        return held <= high


def link(texts: list[str], reach: int = 400) -> list[list[tuple[int, int, int]]]:
    """Reported (start, kind, end) of each text, sorted."""
    out = [sorted(base_spans(t)) for t in texts]
    rows, offset, breaks = [], 0, []
    for i, t in enumerate(texts):
        weak = list(weak_spans(t, out[i]))
        if weak:
            rows += [(i, s + offset, k, e + offset) for s, k, e in [*out[i], *weak]]
            breaks += [offset, *(m.end() + offset for m in _BLANK.finditer(t)), offset + len(t) + 1]
        offset += len(t) + 1
    if not rows:
        return out
    doc, start, kind, end = np.array(rows, np.int64).T
    breaks = np.array(breaks)
    # scopes: reach to either side, within the block between blank lines
    block = np.searchsorted(breaks, start, side="right")
    low = np.maximum(start - reach, breaks[block - 1])
    high = np.minimum(end + reach, np.append(breaks, offset)[np.searchsorted(breaks, end, side="left")])

    def has(*kinds: int) -> np.ndarray:
        of = np.isin(kind, kinds)
        return _Parts(start[of], end[of]).within(low, high)

    base_secret, strong_id = has(0, 2), has(1)
    secret, name, endpoint = base_secret | has(3), has(4), has(5)
    told = (
        ((kind == 3) & (strong_id | (name & endpoint)))
        | ((kind == 4) & (base_secret | (secret & endpoint)))
        | ((kind == 5) & (strong_id | name) & secret)
    )
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    for i, s, k, e in zip(doc[told].tolist(), start[told].tolist(), kind[told].tolist(), end[told].tolist(), strict=True):
        out[i].append((s - int(first[i]), k, e - int(first[i])))
    return [sorted(set(x)) for x in out]


def find_secrets(df: DataFrame, reach: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): the reported spans of every whole text by start, then by the order of ``KINDS``."""

    def work(ids, texts):
        found = link(texts, reach)
        return {"id": ids, "spans": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in found]}

    return map_texts(df, id_col, text_col, f"id bigint, spans array<{SPAN}>", work)


def said(spans: str | Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, mark: str = "[SECRET]", reach: int = 400) -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    return _redacted(text, link([text], reach)[0], mark)


def _redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_texts(df: DataFrame, mark: str = "[SECRET]", reach: int = 400, text_col: str = "text") -> DataFrame:
    """``df`` with the reported spans of a text column replaced; null stays null, other columns are left as they are."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        known = texts.fillna("").tolist()
        done = [_redacted(t, s, mark) if s else t for t, s in zip(known, link(known, reach), strict=True)]
        return pd.Series(done, index=texts.index, dtype=object).where(texts.notna(), None)

    return df.withColumn(text_col, clean(F.col(text_col)))
