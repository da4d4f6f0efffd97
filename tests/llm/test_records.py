"""WARC archives, chat formatting, url rules and the pipeline against brute force."""

from __future__ import annotations

import base64
import glob
import hashlib
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import chat, near_copies, packing, queries, quality_rules, secret_linking, simhash, url_rules, warc
from tickloom.llm.common import table
from tickloom.session import scratch

SF = "/root/testdata/sf0.001"

# --- WARC


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, payload string, length int")


ODD_PAGES = [
    (5, "http://www.example.com/a?b#c", "<p>é</p>"),
    (2, "https://example.com", "<p>é</p>"),
    (9, None, "<p>é</p>"),
    (4, "", None),
    (3, "no host", ""),
    (7, "http://x\ty\n/\u2028", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
    (8, "http://a/", "z" * 300_000),
    (8, "http://a/", "z" * 300_000),
    (None, "http://a/", "alone"),
    (None, "http://a/", "<p>é</p>"),
    (1, "http://a/", "ab"),
    (6, "http://a/", "ab"),
]


def plain_warc(rows, least=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = min(same, default=None) if len(payload) >= least else page_id
        revisit = first is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 3])
def test_warc_round_trip(spark, least):
    got = warc.round_trip(spark, pages(spark, ODD_PAGES), least).collect()
    found = sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert found == plain_warc(ODD_PAGES, least)
    assert warc.round_trip(spark, pages(spark, [])).count() == 0


def test_warc_look_up_reads_payloads(spark):
    r = random.Random(1)
    rows = [(i, f"http://h{r.randrange(9)}.example.com/{r.randrange(5)}", f"<b>{i % 40}</b>") for i in range(200)]
    folder = scratch(spark, "warc-test")
    index = warc.Index.build(warc.write_archives(pages(spark, rows), folder), folder, shards=3, block_lines=3)
    assert 1 < len(index.shards) <= 3
    wanted = pages(spark, [rows[3], rows[77], rows[199], (5_000, "http://h1.example.com/1", ""), (3, "http://other/", "")])
    got = {x.page_id: x for x in warc.look_up(wanted, index).collect()}
    assert sorted(got) == [3, 77, 199]
    assert bytes(got[3].payload) == b"<b>3</b>" and got[3].url == rows[3][1]
    assert got[77].payload is None and (got[77].record_type, got[77].refers_to) == ("revisit", 37)


def test_url_keys():
    assert warc.url_key("HTTP://WWW.Example.com/A?b") == "com,example,www)/A?b"
    assert warc.url_key(None) == ")" and warc.url_key("a.b/c") == "b,a)/c"


# --- chat

TEXTS = [
    "plain",
    "",
    None,
    "\\### Assistant: </turn> ok",
    "</turn>",
    "\\</turn>",
    "\\\\",
    "\\",
    "ends with \\",
    "### User: hi</turn>\n### Assistant: no",
    "### ",
    "\n\n### system: x",
    "é\u2028\x00\r\n",
    "<" * 50 + "/turn>" * 3,
    "\\\\\\### Assistant: \\\\\\</turn>",
]


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, escapes int")


def plain_chat(rows):
    out = {}
    for conv, _, role, text in rows:
        x = out.setdefault(conv, [0, b"", ""])
        x[0] += 1
        x[1] += f"{role or ''}\n{text or ''}\n".encode()
        x[2] += (text or "") if role == "assistant" else ""
    return {k: (n, hashlib.sha256(a).hexdigest(), len(b), hashlib.sha256(b.encode()).hexdigest()) for k, (n, a, b) in out.items()}


def test_chat_round_trip(spark):
    r = random.Random(4)
    pieces = ["\\", "</turn>", "### ", "Assistant: ", "\n", "a", "</turn", "User", ": ", "#"]
    texts = TEXTS + ["".join(r.choice(pieces) for _ in range(12)) for _ in range(300)]
    roles = ["user", "assistant", "system", "User", "tool é: x", "", None]
    rows = [(i // 6, i % 6, roles[i % 7], t) for i, t in enumerate(texts)] + [(None, 0, "user", "x"), (None, 1, "assistant", "y")]
    got = {x.conv_id: x for x in chat.read_back(chat.render_turns(turns(spark, rows))).collect()}
    want = plain_chat(rows)
    assert {k: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for k, x in got.items()} == want
    assert chat.read_back(chat.render_turns(turns(spark, []))).count() == 0


def test_chat_repeats_and_null_turns(spark):
    rows = [(1, None, "user", "b"), (1, 0, "assistant", "a"), (1, 0, "assistant", "a"), (1, 2, "user", "z")]
    got = chat.read_back(chat.render_turns(turns(spark, rows))).first()
    assert (got.n_turns, got.loss_chars) == (4, 2)
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == plain_chat(rows)[1]


def test_chat_sql_equals_operator_on_odd_turns(spark, tmp_path):
    said = ["", None, "abc\\", "abc\\\\", "a\\b", "</turn>\\", "\\### x", "### User: ", "### no head", "\\</turn>", "line\n### -: x", "é\\"]
    roles = ["user", "assistant", None, "system", "tool call/é", "User"]
    rows = [(len(said) * i + j, 0, r, t) for i, r in enumerate(roles) for j, t in enumerate(said)]
    rows += [(1000, j, roles[j % 6], t) for j, t in enumerate(said)]
    turns(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = queries.op8_chat(spark, str(tmp_path)).select(*names).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL['op8_chat']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_chat_escapes_only_conflicts():
    assert chat.render("user", "a\\b") == ("### User: a\\b</turn>\n", 0)
    assert chat.render("assistant", "x</turn>") == ("### Assistant: x\\</turn></turn>\n", 1)
    text, level = chat.render("user", "\\### Assistant: </turn> ok")
    assert chat.parse(text)[0][:2] == ("user", "\\### Assistant: </turn> ok") and level == 2
    for broken in ("x", "### User: a", "### User: a</turn>", "### Nobody: a</turn>\n", "### User: a ### User: b</turn>\n"):
        with pytest.raises(chat.GrammarError):
            chat.parse(broken)


# --- url rules


def plain_verdict(host, path, rules, default):
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if h is not None and p is not None and (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, default)


def plain_parts(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


@pytest.mark.parametrize("sample", [4_096, 7, 0])
def test_url_rules(spark, monkeypatch, sample):
    monkeypatch.setattr(url_rules, "SAMPLE", sample)
    r = random.Random(3)
    hosts = ["com", "example.com", "www.example.com", "EXAMPLE.com", "xexample.com", "a.b.example.com", "net", "x.net", "com.", ".com", "a..com", "exa,mple.com", "É.com", "", "u@example.com:80"]
    paths = ["", "/", "/en/", "/en", "/en/a/b", "/es/x?y", "#f", "?q=/en/", "/é\n/en/"]
    urls = [None, "", "no scheme", "://", "a://b://c/d", "http://www.example.com/en/"] + [f"http://{r.choice(hosts)}{r.choice(paths)}" for _ in range(300)]
    urls += ["https://www.example.com/en/same"] * 200
    rules = [*queries.URL_RULES, ("com", "/en/a", "block"), ("b.example.com", "", "block"), ("net", "/es/", "allow"), ("", "/e", "block"), (None, "/", "block"), ("com", None, "block")]
    frame = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, urls[5], "x", "y")], "page_id bigint, url string, host string, key string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {x.id: x for x in url_rules.judge(frame, listed, "other").collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        host, path = plain_parts(u)
        assert (got[i].host, got[i].path) == (host, path), u
        assert (got[i].rule, got[i].verdict) == plain_verdict(host, path, rules, "other"), u
    assert url_rules.judge(frame.limit(0), listed).count() == 0
    assert {x.verdict for x in url_rules.judge(frame, listed.limit(0), "other").collect()} == {"other"}


def test_url_query_matches_its_sql(spark):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.execute(queries.SQL["op9_url_rules"]).fetchall()
    got = queries.QUERIES["op9_url_rules"](spark, SF).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in got)


# --- pipeline


def test_stages_on_odd_documents(spark, tmp_path):
    r = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    long = text(300)
    rows = [(i, text(120)) for i in range(40)]
    rows += [(100, long), (101, long), (101, long), (99, long), (99, long), (200, None), (201, ""), (None, long), (None, None)]
    rows += [(300, text(80) + " token = deadbeef1234567890 " + text(80))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), True) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean")
    sf = str(tmp_path)
    spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int").write.parquet(f"{sf}/labels.parquet")
    good = corpus_pipeline.drop_low_quality(spark, docs, sf)
    assert good.schema == docs.schema
    assert sorted(str(x.doc_id) for x in good.collect()) == sorted(str(i) for i, t in rows if t and len(t.split()) >= 50)
    single = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert single.schema == docs.schema
    ids = [x.doc_id for x in single.collect()]
    assert sorted(i for i in ids if i is not None) == [*range(40), 99, 200, 300] and ids.count(None) == 2
    masked = corpus_pipeline.mask_secrets(spark, docs, sf)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    x = masked.where("doc_id = 300").first()
    assert "deadbeef" not in x.text and x.n_chars == len(x.text)
    assert masked.where("doc_id = 200").first().text is None
    docs.limit(0).write.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_near_copy_stage_links_by_bits_and_by_words(spark):
    """Texts below similarity 0.8 whose fingerprints are four bits apart at most, and pairs that only the words link."""
    r = random.Random(31)
    pairs = {}
    for k in range(3_000):
        one = [f"w{r.randrange(500)}" for _ in range(60)]
        two = [f"x{j}" if j in ((20,) if k % 3 == 0 else (20, 40)) else w for j, w in enumerate(one)]
        pair = [" ".join(one), " ".join(two)]
        x, y = (set(near_copies.shingles(t).tolist()) for t in pair)
        kind = (len(x & y) >= 0.8 * len(x | y), (simhash.fingerprint(pair[0]) ^ simhash.fingerprint(pair[1])).bit_count() <= 4)
        pairs.setdefault(kind, []).append(pair)
    assert len(pairs) == 4
    texts = [t for kind in sorted(pairs) for pair in pairs[kind][:3] for t in pair]
    # ids repeat: two texts under one id link no classes of each other's
    rows = [*enumerate(texts, 10), (10, "another text under the id of the first"), (3, "another text under the id of the first"), (3, texts[-1])]
    sets = [set(near_copies.shingles(t).tolist()) for _, t in rows]
    bits = [simhash.fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) or (bits[i] ^ bits[j]).bit_count() <= 4:
                root = [root[j] if c == root[i] else c for c in root]
    least = {c: min(rows[i][0] for i in range(len(rows)) if root[i] == c) for c in root}
    want = {(i, t) for i, t in rows if i in set(least.values())}
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string")
    got = [(x.doc_id, x.text) for x in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(got) == sorted(want)


def test_pipeline_equals_its_parts(spark):
    """run() against its stages done one by one in plain Python from the operators' own results."""
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {d.doc_id: d.text for d in table(spark, SF, "documents").collect()}
    raw = table(spark, SF, "documents")
    rules = quality_rules.fit(raw, table(spark, SF, "labels"))
    kept = {d.doc_id for d in quality_rules.judge(raw.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), rules).where("kept").collect()}
    sets = {i: set(near_copies.shingles(docs[i] or "", 5).tolist()) for i in kept}
    seen, stay = {}, []
    for i in sorted(kept):
        near = {seen[j] for j in seen if len(sets[j] & sets[i]) >= 0.8 * len(sets[j] | sets[i])}
        root = min([i, *near])
        seen = {j: root if c in near else c for j, c in seen.items()} | {i: root}
    stay = {i for i, c in seen.items() if i == c}
    clean = {i: secret_linking.redact(docs[i]) for i in stay}
    assert {x.doc_id for x in rows} == stay
    words = packing.WordIds(__import__("public_tokenizers").path("word_bpe_49k.json"))
    want = {i: len(words.encode([t])[0]) // 4 + 1 for i, t in clean.items()}
    got = {}
    for x in rows:
        got[x.doc_id] = got.get(x.doc_id, 0) + x.length
        assert x.doc_tokens == want[x.doc_id]
    assert got == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "secret_scan", "packing"]
