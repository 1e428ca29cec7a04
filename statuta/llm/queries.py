"""The registered queries of this package and, where SQL can say it, what they should return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.llm import asof, bpe, divergence, fingerprints, langid, linededup, mixing, neardup, pii, tokencount, toolcalls, toxicity, vectors
from statuta.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op1_pii finds by its patterns and checksums alone, for which there is SQL."""
    return op1_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.report(table(spark, sf_dir, "documents"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.report(table(spark, sf_dir, "conversations"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.clicks_to_orders(table(spark, sf_dir, "clicks"), table(spark, sf_dir, "sales"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_language_id, op3_mixing, op4_fingerprints, op5_token_counts, op6_tool_calls, op7_bpe, op8_minhash, op9_pq, op10_toxicity, op11_asof, op12_divergence, op13_line_dedup, pii_base_spans)}


OP3_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
placed AS (
  SELECT *, CAST(floor(ln(size + 1.0) * 6) AS INTEGER) AS class,
         CAST(floor(CAST('0x' || substr(digest, 1, 2) AS INTEGER) * 64 / 256.0) AS INTEGER) AS salt FROM sized),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM placed GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         source_size * 2 AS cap FROM totals),
filled AS (SELECT *, CAST(cap AS DOUBLE) / weight AS full_at FROM weighed),
levels AS (
  SELECT *, row_number() OVER (ORDER BY full_at, source ASC NULLS LAST) AS rnk,
         (CAST((SELECT sum(source_size) FROM totals) AS DOUBLE) * 1.5
            - CAST(coalesce(sum(cap) OVER (ORDER BY full_at, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / CAST((SELECT sum(weight) FROM weighed)
            - coalesce(sum(weight) OVER (ORDER BY full_at, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM filled),
chosen AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY rnk LIMIT 1),
aims AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT level FROM chosen) * weight) AS target FROM levels),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, salt, digest, doc_id, size) AS place,
         CAST(CAST('0x' || substr(md5('mix-1:' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS shift
  FROM placed),
mixed AS (
  SELECT r.doc_id, r.size, a.source_size, a.target, r.place, r.shift,
         CASE WHEN a.source_size > 0 THEN a.target / CAST(a.source_size AS DOUBLE) ELSE 1.0 END AS rate
  FROM ranked r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(CAST(place AS DOUBLE) * rate + shift) - floor(CAST(place - 1 AS DOUBLE) * rate + shift)) * size AS BIGINT) AS taken
FROM mixed
"""


#: A user's turns are calls; consecutive ones two turns apart form chains.  Valid for unique (conv_id, turn).
OP6_SQL = """
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, text, role,
         CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind
  FROM conversations),
c AS (SELECT conv_id, turn, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM t WHERE kind = 'call'),
d AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) AS depth FROM c),
r AS (SELECT conv_id, turn - 1 AS call_turn FROM t WHERE kind = 'result'),
s AS (
  SELECT t.*, own.depth AS own_depth, r.call_turn, prior.depth AS prior_depth FROM t
  LEFT JOIN d own ON t.kind = 'call' AND own.conv_id = t.conv_id AND own.turn = t.turn
  LEFT JOIN r ON t.kind = 'call' AND r.conv_id = t.conv_id AND r.call_turn = t.turn
  LEFT JOIN d prior ON t.kind = 'result' AND prior.conv_id = t.conv_id AND prior.turn = t.turn - 1)
SELECT conv_id, turn, kind,
       CASE kind WHEN 'message' THEN 'message' WHEN 'call' THEN CASE WHEN call_turn IS NULL THEN 'pending' ELSE 'linked' END
                 ELSE CASE WHEN prior_depth IS NULL THEN 'orphan' ELSE 'linked' END END AS status,
       CAST(coalesce(own_depth, prior_depth, 0) AS BIGINT) AS depth,
       CAST(coalesce(CASE kind WHEN 'call' THEN 2 * own_depth - 1 WHEN 'result' THEN 2 * prior_depth END, 0) AS BIGINT) AS position,
       CASE WHEN kind = 'call' THEN coalesce(length(text) >= 1 AND turn >= 0, false) ELSE true END AS valid,
       CASE kind
         WHEN 'call' THEN '{"arguments":{"prompt":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},"id":"' || conv_id || ':' || turn || '","name":"reply","type":"call"}'
         WHEN 'result' THEN '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"id":"' || conv_id || ':' || (turn - 1) || '","type":"result"}'
         ELSE '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"type":"message"}' END AS json
FROM s
"""

#: Every pair that shares a shingle is counted out, and components are followed link by link.
OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
s AS (SELECT doc_id, CASE WHEN len(t) < 2 THEN t ELSE list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) END AS held FROM w),
u AS (SELECT doc_id, len(held) AS n, unnest(held) AS h FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, p.b FROM reach r JOIN p ON p.a = r.other),
root AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.held) AS BIGINT) AS n_shingles, root.component_id, s.doc_id = root.component_id AS kept FROM s JOIN root USING (doc_id)
"""

OP9_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, p.b FROM reach r JOIN p ON p.a = r.other),
root AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT root.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, root.component_id, root.vec_id = root.component_id AS kept
FROM root LEFT JOIN n ON n.a = root.vec_id
"""


OP11_SQL = """
WITH h AS (
  SELECT id, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)))) AS crc
  FROM (SELECT click_id AS id FROM clicks UNION SELECT sale_id FROM sales) WHERE id IS NOT NULL),
c AS (
  SELECT DISTINCT click_id, client_id, CASE WHEN crc % 2 = 1 THEN epoch_us(ts) - epoch_us(ts) % 21600000000 ELSE epoch_us(ts) END AS ts_us
  FROM clicks LEFT JOIN h ON h.id = click_id),
s AS (
  SELECT sale_id, client_id, CASE WHEN crc % 2 = 1 THEN epoch_us(sold_at) - epoch_us(sold_at) % 21600000000 ELSE epoch_us(sold_at) END AS placed,
         CAST(floor(100 * total + 0.5) AS BIGINT) AS cents, coalesce(crc % 3, 0) AS third
  FROM sales LEFT JOIN h ON h.id = sale_id WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
o AS (SELECT sale_id, client_id, placed, cents FROM s UNION ALL SELECT -1 - sale_id, client_id, placed, cents FROM s WHERE third <> 0),
b AS (
  SELECT *, count(*) OVER (PARTITION BY client_id, placed) AS tied, row_number() OVER (PARTITION BY client_id, placed ORDER BY cents DESC NULLS LAST, sale_id DESC NULLS LAST) AS place FROM o),
m AS (
  SELECT c.*, b.sale_id, b.placed, b.cents, b.tied, c.ts_us - b.placed <= 2592000000000 AS near
  FROM c ASOF LEFT JOIN (SELECT * FROM b WHERE place = 1) b ON c.client_id = b.client_id AND c.ts_us >= b.placed)
SELECT click_id, client_id, ts_us, CASE WHEN near THEN sale_id END AS sale_id, CASE WHEN near THEN ts_us - placed END AS lag_us,
       CASE WHEN near THEN cents END AS total_cents, CAST(CASE WHEN near THEN tied ELSE 0 END AS BIGINT) AS n_tied
FROM m
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
c AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n, kept.n AS n_lang, size.v, size.total AS total_lang
      FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
             1 + (1000000000::HUGEINT * (n_lang + 1)) // (total_lang + v) AS q FROM c),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""

OP13_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS every FROM documents),
l AS (SELECT doc_id, unnest(every) AS line, generate_subscripts(every, 1) AS place FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[ 	-
]+', ''), '[ 	-
]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.line, k.place, common.key IS NOT NULL AND k.doc_id <> common.top AS goes FROM k LEFT JOIN common ON common.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(goes) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DIGIT = "CAST(digits[len(digits) - k] AS INTEGER)"
_LUHN = f"list_sum(list_transform(range(len(digits)), lambda k: CASE WHEN k % 2 = 0 THEN {_DIGIT} WHEN {_DIGIT} > 4 THEN 2 * {_DIGIT} - 9 ELSE 2 * {_DIGIT} END)) % 10 = 0"
#: A match stands behind the texts between the matches up to it, and these matches.
PII_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), m AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {i} AS place, '{kind}' AS kind, unnest(regexp_extract_all(text, '{p}')) AS found, unnest(regexp_split_to_array(text, '{p}')[:len(regexp_extract_all(text, '{p}'))]) AS gap, generate_subscripts(regexp_extract_all(text, '{p}'), 1) AS nth FROM d"
        for i, (kind, p) in enumerate(_PATTERNS.items())
    )
    + "), s AS (SELECT *, CAST(sum(length(gap) + length(found)) OVER (PARTITION BY doc_id, kind ORDER BY nth) AS BIGINT) AS until, regexp_replace(found, '[^0-9]', '', 'g') AS digits FROM m), "
    "ok AS (SELECT * FROM s WHERE CASE kind WHEN 'email' THEN true WHEN 'ip' THEN list_max(list_transform(string_split(found, '.'), lambda x: CAST(x AS DOUBLE))) <= 255 "
    f"WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15 ELSE length(digits) BETWEEN 16 AND 19 AND {_LUHN} END) "
    "SELECT doc_id, " + ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in _PATTERNS)
    + ", sha256(coalesce(string_agg(kind || ':' || (until - length(found)) || ':' || until, ',' ORDER BY place, nth), '')) AS base_sha256 FROM d LEFT JOIN ok USING (doc_id) GROUP BY doc_id"
)


def oracle_sql() -> dict[str, str]:
    return {"pii_base_spans": PII_SQL, "op3_mixing": OP3_SQL, "op6_tool_calls": OP6_SQL, "op8_minhash": OP8_SQL, "op9_pq": OP9_SQL, "op11_asof": OP11_SQL, "op12_divergence": OP12_SQL, "op13_line_dedup": OP13_SQL}
