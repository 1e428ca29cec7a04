"""Queries over web pages: their blocks, and the article operators on pages as articles.

The SQL is a second parser of its own: it cuts pages by regular expressions, which the test pages
allow, as their blocks hold nothing but text, links, bold type and line ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.operators import search, structure, textdiff
from statuta.queries import query, table
from statuta.sources import html

_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&"))
_INLINE = "</?(?:a|b|br)(?: [^>]*)?>"


def _text_sql(x: str) -> str:
    x = f"trim(regexp_replace(regexp_replace(replace({x}, '<br>', ' '), '<[^>]*>', '', 'g'), '[ \\t\\n\\f\\r]+', ' ', 'g'))"
    for entity, sign in _ENTITIES:
        x = f"replace({x}, '{entity}', '{sign}')"
    return x


_CLEAN = "regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|<head>.*?</head>', '', 'g')"
_CUT = f"'<(p|h1|li|div|footer)(?: [^>]*)?>((?:[^<]|{_INLINE})*)'"
_BLOCKS = (
    f"(SELECT page_id, host, row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS place, kind, text FROM (SELECT page_id, host, nth, kind, {_text_sql('raw')} AS text FROM "
    f"(SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, unnest(regexp_extract_all(h, {_CUT}, 1)) AS kind, unnest(regexp_extract_all(h, {_CUT}, 2)) AS raw, "
    f"generate_subscripts(regexp_extract_all(h, {_CUT}, 1), 1) AS nth FROM (SELECT page_id, url, {_CLEAN} AS h FROM pages))) WHERE text <> '')"
)
_LINK = "'<a href=\"([^\"]*)\">((?:[^<]|</?b>)*)'"
_LINKS = (
    f"(SELECT page_id, nth - 1 AS place, {_text_sql('raw')} AS text, {_text_sql('target')} AS href FROM (SELECT page_id, unnest(regexp_extract_all(h, {_LINK}, 2)) AS raw, unnest(regexp_extract_all(h, {_LINK}, 1)) AS target, "
    f"generate_subscripts(regexp_extract_all(h, {_LINK}, 1), 1) AS nth FROM (SELECT page_id, {_CLEAN} AS h FROM pages)))"
)
_ESCAPED = "CASE WHEN text[1] IN ('#', '|') THEN '\\' ELSE '' END || text"
_LINES = f"string_agg(CASE kind WHEN 'p' THEN '### ' || chr(10) || {_ESCAPED} WHEN 'li' THEN '- ' || text ELSE {_ESCAPED} END, chr(10) ORDER BY place) FILTER (WHERE place IS DISTINCT FROM top)"
_ROW = "'| ' || replace(text, '|', '｜') || ' | ' || replace(href, '|', '%7C') || ' |'"
_BODIES = (
    f"(SELECT p.page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, b.caption, '# ' || host || ' 第' || p.page_id || '条' || coalesce('(（' || b.caption || '）)', '') || chr(10) || coalesce(b.lines || chr(10), '') || coalesce(chr(10) || l.rows || chr(10), '') AS body FROM pages p "
    f"LEFT JOIN (SELECT page_id, any_value(caption) AS caption, {_LINES} AS lines FROM (SELECT *, min(place) FILTER (WHERE kind = 'h1') OVER (PARTITION BY page_id) AS top, arg_min(text, place) FILTER (WHERE kind = 'h1') OVER (PARTITION BY page_id) AS caption FROM {_BLOCKS}) GROUP BY page_id) b ON b.page_id = p.page_id "
    f"LEFT JOIN (SELECT page_id, string_agg({_ROW}, chr(10) ORDER BY place) AS rows FROM {_LINKS} GROUP BY page_id) l ON l.page_id = p.page_id)"
)
_ID = "host || '-art-' || page_id"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    return html.articles(table(spark, sf_dir, "pages").select(host.alias("law_abbrev"), F.col("page_id").alias("article_number"), "html"))


@query(f"SELECT page_id, CAST(place AS INTEGER) AS place, kind, text FROM {_BLOCKS}")
def page_blocks(spark, sf_dir):
    """Headings, paragraphs, list items and other blocks; their places count links as well, so they are counted anew."""
    from pyspark.sql import Window as W

    rows = html.page_blocks(table(spark, sf_dir, "pages"), "html", "page_id").where("kind <> 'a'")
    return rows.select("page_id", (F.row_number().over(W.partitionBy("page_id").orderBy("place")) - 1).alias("place"), "kind", "text")


@query(f"SELECT page_id, text, href FROM {_LINKS}")
def page_links(spark, sf_dir):
    return html.page_blocks(table(spark, sf_dir, "pages"), "html", "page_id").where("kind = 'a'").select("page_id", "text", "href")


@query(f"SELECT {_ID} AS article_id, body FROM {_BODIES}")
def page_bodies(spark, sf_dir):
    return articles(spark, sf_dir).select("article_id", "body")


@query(f"SELECT {_ID} AS article_id, caption FROM {_BODIES}")
def page_captions(spark, sf_dir):
    return articles(spark, sf_dir).select("article_id", structure.caption(F.col("body")).alias("caption"))


_PARAGRAPHS = (
    f"(SELECT article_id, CAST(nth - 1 AS INTEGER) AS number, trim(regexp_replace(part, '^[^\\n]*\\n?', ''), E'\\n ') AS text FROM (SELECT article_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS nth "
    f"FROM (SELECT {_ID} AS article_id, regexp_split_to_array(chr(10) || body, '\\n### ') AS parts FROM {_BODIES})) WHERE nth > 1)"
)


@query(f"SELECT article_id, number, '' AS heading, text FROM {_PARAGRAPHS}")
def page_paragraphs(spark, sf_dir):
    return structure.paragraphs(articles(spark, sf_dir)).select("article_id", "number", "heading", "text")


@query(f"SELECT article_id || '-p' || number AS id, '<!-- segment: simple id: ' || article_id || '-p' || number || ' -->' || chr(10) || text AS marked FROM {_PARAGRAPHS}")
def page_markers(spark, sf_dir):
    from statuta.functions import clauses

    rows = structure.paragraphs(articles(spark, sf_dir))
    return rows.select(F.explode(clauses.segments(F.col("article_id"), F.col("number"), F.col("text"))).alias("s")).select("s.id", structure.marked(F.col("s")).alias("marked"))


@query(
    f"SELECT article_id, CAST(line - 1 AS INTEGER) AS line, CAST(place - 1 AS INTEGER) AS place, trim(cell) AS cell FROM (SELECT article_id, line, unnest(cells) AS cell, generate_subscripts(cells, 1) AS place FROM "
    f"(SELECT article_id, line, string_split(substr(content, 2, length(content) - 2), '|') AS cells FROM (SELECT {_ID} AS article_id, unnest(string_split(body, chr(10))) AS content, generate_subscripts(string_split(body, chr(10)), 1) AS line FROM {_BODIES}) "
    "WHERE content LIKE '|%|' AND length(content) > 1 AND translate(content, ' :|-', '') <> ''))"
)
def page_table_cells(spark, sf_dir):
    return structure.table_cells(articles(spark, sf_dir), "body", "article_id").withColumnRenamed("column", "place")


@query(
    "SELECT a.doc_id, b.doc_id AS next_id, sha256(coalesce(b.text, '')) AS restored_sha256, CAST(len(string_split(coalesce(b.text, ''), chr(10))) - len(string_split(coalesce(a.text, ''), chr(10))) AS BIGINT) AS lines_more, coalesce(a.text, '') = coalesce(b.text, '') AS same "
    "FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"
)
def document_differences(spark, sf_dir):
    """Each document against the one with the next id: its hunks, put to its text, give the other."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = docs.join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next")), "doc_id")
    found = textdiff.differences(pairs, "text", "next", "doc_id", "text")
    more = F.aggregate("hunks", F.lit(0).cast("long"), lambda n, h: n + F.size(h["added"]) - h["removed"])
    back = textdiff.applied(found.withColumns({"lines_more": more, "same": F.size("hunks") == 0}), "text", "hunks", "doc_id", "lines_more", "same")
    return back.select("doc_id", (F.col("doc_id") + 1).alias("next_id"), F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"), "lines_more", "same")


_TERMS = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"


@query(
    f"WITH d AS (SELECT doc_id, {_TERMS.format(t='text')} AS w FROM documents WHERE text IS NOT NULL), s AS (SELECT count(*) AS n, greatest(1, CAST(sum(len(w)) AS BIGINT) // count(*)) AS mean FROM d), "
    "u AS (SELECT doc_id, len(w) AS length, unnest(w) AS term FROM d), t AS (SELECT doc_id, term, length, count(*) AS tf FROM u GROUP BY ALL), "
    "i AS (SELECT term, CAST(round(ln(1 + n / count(*)) * 1000) AS BIGINT) AS idf FROM t, s GROUP BY term, n), "
    f"q AS (SELECT DISTINCT item_id, unnest({_TERMS.format(t='text')}) AS term FROM benchmark), "
    "c AS (SELECT item_id, doc_id, CAST(sum(idf * (tf * 2200000 // (tf * 1000 + 300 + length * 900 // mean))) AS BIGINT) AS score FROM q JOIN i USING (term) JOIN t USING (term), s GROUP BY item_id, doc_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c) SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"
)
def benchmark_search(spark, sf_dir):
    """The ten documents that rank first for each item of the benchmark."""
    index = search.build(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = search.search(index, table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select(F.col("query").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
