"""SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from stratamart.llm.chat import CONTROLS, END, TEXT, TURN
from stratamart.llm.fixed import URL_RULES

URL_FILTER = f"""
WITH rules(rule_host, rule_path, action) AS (
    VALUES {", ".join(str(r) for r in URL_RULES)}
),
rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
    FROM pages
),
parts AS (
    SELECT page_id,
        translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
)
SELECT page_id, host, path,
    max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    coalesce(max_by(action, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""

SHARDING = """
WITH keyed AS (
    SELECT doc_id, coalesce(source, '') AS mark, source IS NULL AS no_source, source,
        octet_length(encode(coalesce(text, ''))) + 8 AS size,
        ('0x' || substr(md5('shards-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS k,
        coalesce(text, '') AS body
    FROM documents
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY no_source, mark ORDER BY k, doc_id) - 1 AS r,
        count(*) OVER (PARTITION BY no_source, mark) AS n
    FROM keyed
),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r + 1) / (2.0::DOUBLE * n), no_source, mark, r) - 1 AS place,
        count(*) OVER () AS total
    FROM ranked
),
crc_table AS (
    SELECT list(list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) s(i)
),
bytes AS (
    SELECT doc_id, size, place, total, source,
        list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT) AS b
    FROM placed
)
SELECT doc_id, size,
    xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
    'rows' AS law, (place * 24 // total)::INTEGER AS shard,
    place - ((place * 24 // total) * total + 23) // 24 AS slot, NULL::INTEGER AS grown_shard, source
FROM bytes, crc_table
"""

# Control strings after their first character, as in chat.CONTROLS.
TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)

CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
held AS (
    SELECT *, length(regexp_replace(role, '([<\\[])(\\\\*)({TAILS})', '\\1\\\\\\2\\3', 'g'))
        + length(regexp_replace(text, '([<\\[])(\\\\*)({TAILS})', '\\1\\\\\\2\\3', 'g'))
        + {len(TURN + TEXT + END)} AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM held GROUP BY conv_id
"""

TOP_K = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

WARC = """
WITH rows AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
),
kept AS (
    SELECT *, CASE WHEN payload_bytes >= 1000
        THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS last
    FROM rows
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < last THEN last END AS refers_to
FROM kept
"""

NGRAM_JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
reach(x, y) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach ON reach.x = d.doc_id
GROUP BY d.doc_id, n
"""

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
terms AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (
    SELECT lang, term, count(*) AS whole FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 3
),
langs AS (
    SELECT lang, count(term) AS v, coalesce(sum(whole), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
),
counts AS (SELECT lang, source, term, count(*) AS c FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) GROUP BY ALL
),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (g.n + l.v) AS p,
        1 + (1000000000::HUGEINT * (whole + 1)) // (l.n + l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum((a.p - b.p) * (a.p - b.p) // b.p), 0)::BIGINT AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    JOIN langs l ON l.lang = a.lang AND l.v = 0
),
found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""
RESAMPLING = r"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
wanted AS (
    SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f
    FROM benchmark
),
features AS (SELECT d, unnest(w) AS f FROM words),
crc_table AS (
    SELECT list(list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) s(i)
),
steps AS (
    SELECT f, t, hex(encode(f)) AS h FROM (SELECT f FROM features UNION SELECT f FROM wanted), crc_table
),
buckets AS (
    SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM steps
),
s AS (SELECT bucket, count(*) AS n FROM features JOIN buckets USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
gains AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
        / ((s.n + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), totals
),
weights AS (SELECT d, sum(gain)::BIGINT AS weight FROM features JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY d),
scores AS (
    SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (d)
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= 20 AND r <= 10 * count(*) FILTER (n_features >= 20) OVER () // 100 THEN r END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r FROM scores)
"""

ORACLES = {
    "op2_ngram_jaccard": NGRAM_JACCARD,
    "op5_chat_format": CHAT,
    "op6_exact_topk": TOP_K,
    "op8_warc": WARC,
    "op7_sharding": SHARDING,
    "op10_url_filter": URL_FILTER,
    "op11_divergence": DIVERGENCE,
    "op13_resampling": RESAMPLING,
}
