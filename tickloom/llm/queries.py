"""One registered query per text operator, over its whole table; ``SQL`` holds the twins that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tickloom.llm import (
    bpe_codec,
    chat,
    merkle,
    packing,
    phrases,
    quality_rules,
    secret_linking,
    simhash,
    syncmers,
    token_store,
    token_transducer,
    url_rules,
    warc,
)
from tickloom.llm.common import table

QUERIES = {}
SQL = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_codec.round_trip(docs, path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query
def op2_token_counts(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_transducer.count_tokens(table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


@query
def op3_secrets(spark, sf_dir):
    found = secret_linking.find_secrets(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = (secret_linking.ASSIGN, secret_linking.ACCESS, secret_linking.HEX)
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(secret_linking.said(of(*base)), 256).alias("base_sha256"),
        secret_linking.said("spans").alias("spans"),
    )


@query
def op4_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=2, window=4096)
    return placed.drop("piece_no")


@query
def op5_simhash_classes(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, seed=42, budget=4)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op6_warc(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages"), least_bytes=0)


#: Base32 of a SHA-1: each sign has five bits, which lie in two neighbouring hex digits.
SQL["op6_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, payload, sha1(payload) || '0' AS x, min(page_id) OVER (PARTITION BY payload) AS f FROM p),
d AS (SELECT *, list_transform(range(1, 42), lambda i: strpos('0123456789abcdef', substr(x, CAST(i AS BIGINT), 1)) - 1) AS n FROM h)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((n[1 + 5 * g // 4] * 16 + n[2 + 5 * g // 4]) >> (3 - (5 * g) % 4)) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM d
"""


@query
def op7_syncmers(spark, sf_dir):
    return syncmers.compare_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op8_chat(spark, sf_dir):
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.render_turns(turns))


#: A text is written plainly, with its marks escaped, or with marks and backslashes escaped: the first that reads back.
SQL["op8_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, CASE
    WHEN NOT regexp_matches(text, '</turn>|### (?:[A-Za-z]+|-|=[A-Za-z0-9%_.~-]*): |\\(?:\\|### |$)') THEN 0
    WHEN NOT regexp_matches(text, '\\(?:\\|</turn>|### (?:[A-Za-z]+|-|=[A-Za-z0-9%_.~-]*): |$)') THEN len(regexp_extract_all(text, '</turn>|### '))
    ELSE len(regexp_extract_all(text, '\\|</turn>|### ')) END AS escapes,
    CASE WHEN role IS NULL THEN 1 WHEN role IN ('system', 'user', 'assistant') THEN length(role) ELSE 1 + length(url_encode(role)) END AS name
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ') + name + length(': ') + length(text) + escapes + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


#: Fixed values: (host, path, verdict) of the rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op9_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


SQL["op9_url_rules"] = f"""
WITH parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
fitting AS (
  SELECT page_id, host, path, max(length(r_host) + length(r_path)) AS size,
    arg_max(r_host || r_path, length(r_host) + length(r_path)) AS rule,
    arg_max(r_verdict, length(r_host) + length(r_path)) AS verdict
  FROM parsed LEFT JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting
"""


@query
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    judged = quality_rules.judge(texts, rules)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op13_token_store(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_store.round_trip(spark, table(spark, sf_dir, "documents"), path, end_id=0).withColumnRenamed("id", "doc_id")


@query
def op11_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    shifted = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns]
    # the tampered leaf is made beside the true one, so the texts are read once
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    rows = merkle.manifest(docs, columns, "lang", "doc_id", keep={"tampered": F.when(touched, merkle.leaf_of(*shifted))})
    fold = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), fold.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _bytes_and_value(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_LEAF = "sha256({})".format(" || ".join(_bytes_and_value(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
#: CRC-32 of a number's decimal digits: eight shifts for each byte.
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda x, y: list_reduce(list_concat([xor(x, y)], [CAST(i AS BIGINT) FOR i IN range(8)]), lambda z, i: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END)), 4294967295)"""
SQL["op11_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce(':' || lang, '') AS g, {_LEAF} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.replace("n_chars", "(n_chars + 1)")} END AS tampered
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM leaves),
tree AS (
  SELECT g, 0 AS level, k, leaf AS digest FROM placed
  UNION ALL
  SELECT g, level + 1, k // 2, sha256(string_agg(digest, '' ORDER BY k)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM tree)
  WHERE n > 1 GROUP BY g, level, k // 2),
subroots AS (SELECT g, arg_max(digest, level) AS subroot, max(level) AS height, row_number() OVER (ORDER BY g) - 1 AS place FROM tree GROUP BY g),
top AS (
  SELECT 0 AS level, place AS k, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, k // 2, sha256(string_agg(digest, '' ORDER BY k)) FROM (SELECT *, count(*) OVER () AS n FROM top)
  WHERE n > 1 GROUP BY level, k // 2),
roots AS (SELECT arg_max(digest, level) AS root, max(level) AS height FROM top),
steps AS (
  SELECT p.g, p.k, CAST(l AS BIGINT) AS step, t.digest, t.k > p.k >> l AS behind
  FROM placed p JOIN subroots s USING (g), unnest(range(s.height)) AS u(l) LEFT JOIN tree t ON t.g = p.g AND t.level = l AND t.k = xor(p.k >> l, CAST(1 AS BIGINT))
  UNION ALL
  SELECT p.g, p.k, s.height + l, t.digest, t.k > s.place >> l
  FROM placed p JOIN subroots s USING (g), roots, unnest(range(roots.height)) AS u(l) LEFT JOIN top t ON t.level = l AND t.k = xor(s.place >> l, CAST(1 AS BIGINT))),
fold AS (
  SELECT g, k, CAST(0 AS BIGINT) AS step, coalesce(tampered, leaf) AS held FROM placed
  UNION ALL
  SELECT f.g, f.k, f.step + 1, sha256(CASE WHEN s.digest IS NULL THEN held WHEN behind THEN held || s.digest ELSE s.digest || held END)
  FROM fold f JOIN steps s ON s.g = f.g AND s.k = f.k AND s.step = f.step),
ends AS (SELECT g, k, arg_max(held, step) AS folded_root FROM fold GROUP BY g, k),
proofs AS (SELECT g, k, sha256(coalesce(string_agg(digest, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY g, k)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (g) JOIN ends USING (g, k) LEFT JOIN proofs USING (g, k), roots
"""


@query
def op12_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, best=2_000)


SQL["op12_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?
-
]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]'), lambda x: x <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, s AS size, array_to_string(w[i : i + s - 1], ' ') AS phrase FROM spots, (VALUES (1), (2), (3)) AS v(s) WHERE i + s - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
halves AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail FROM candidates, (VALUES (1), (2)) AS v(k) WHERE k < size),
parts AS (SELECT lang, phrase, a, k, head AS part, true AS first FROM halves UNION ALL SELECT lang, phrase, a, k, tail, false FROM halves),
counted AS (
  SELECT p.lang, p.phrase, p.a, p.k, max(f.n) FILTER (first) AS l, max(f.n) FILTER (NOT first) AS r
  FROM parts p JOIN f ON f.lang = p.lang AND f.phrase = p.part GROUP BY ALL),
cuts AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM counted),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE size = 3),
longest AS (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY ALL),
stay AS (SELECT s.* FROM scored s LEFT JOIN longest g USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stay)
SELECT lang, rank, phrase, a, l, r, CAST(t.n AS BIGINT) AS n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""
