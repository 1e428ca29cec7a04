"""The registered queries of the article operators, each with the SQL that says what it returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta import samples as S
from statuta import schema
from statuta.functions import anonymize as A
from statuta.functions import clauses, domains, keys, numerals
from statuta.operators import citations, closure, details, integrity, safety, structure, versions
from statuta.plans import reports
from statuta.sources import articles as files
from statuta.sources.scratch import scratch
from statuta.streaming import questions as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(col: str) -> F.Column:
    return F.concat_ws("|", col)


# SQL's regular expressions have no look-around, so the oracle cuts texts into tokens instead.
_WS = r"[\s\p{Z}\x{85}\x{B}\x{1C}-\x{1F}]"
_ERA = rf"(?:令和|平成|昭和|大正|明治){_WS}*\p{{Nd}}+{_WS}*年"
_ART = r"第\p{Nd}+[条項号]"


def _anon_sql(t: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({t}, '{_ERA}|{_ART}|\p{{Nd}}+|\P{{Nd}}'), lambda x: CASE WHEN regexp_matches(x, '^(?:{_ERA})$') "
        rf"THEN '[ERA][N]年' WHEN regexp_matches(x, '^{_ART}$') THEN x WHEN regexp_matches(x, '^\p{{Nd}}') THEN '[N]' ELSE x END), '')"
    )


def _tokens_sql(t: str) -> str:
    every = rf"regexp_extract_all({t}, '{_ERA}|{_ART}|\p{{Nd}}+')"
    return (
        f"CAST(len(list_filter({every}, lambda x: regexp_matches(x, '年$'))) AS BIGINT) AS eras, CAST(len(list_filter({every}, lambda x: regexp_matches(x, '^第'))) AS BIGINT) AS articles, "
        f"CAST(len(list_filter({every}, lambda x: NOT regexp_matches(x, '年$') AND NOT regexp_matches(x, '^第'))) AS BIGINT) AS numbers"
    )


_PII_SQL = (
    r"(regexp_matches({t}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') OR regexp_matches({t}, '(?:^|[^\p{{Nd}}-])(?:\+81[- ]?|0)[0-9]{{1,4}}[- ][0-9]{{1,4}}[- ][0-9]{{3,4}}(?:$|[^\p{{Nd}}-])') "
    r"OR regexp_matches({t}, '〒\s*[0-9]{{3}}-?[0-9]{{4}}') OR regexp_matches({t}, '(?:^|[^\p{{Nd}}])[0-9]{{4}}[ -]?[0-9]{{4}}[ -]?[0-9]{{4}}(?:$|[^\p{{Nd}}])'))"
)


@query(f"SELECT doc_id, {_anon_sql('text')} AS anonymized FROM documents")
def anonymize_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", A.anonymize(F.col("text")).alias("anonymized"))


@query(f"SELECT id, {_anon_sql('question')} AS anonymized FROM {S.QUESTIONS.sql()}")
def anonymize_literals(spark, sf_dir):
    return S.QUESTIONS.frame(spark, sf_dir).select("id", A.anonymize(F.col("question")).alias("anonymized"))


@query(f"SELECT doc_id, {_tokens_sql('text')} FROM documents")
def token_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", A.token_counts(F.col("text")).alias("n")).select("doc_id", "n.*")


@query(f"SELECT id, {_tokens_sql('question')} FROM {S.QUESTIONS.sql()} WHERE question IS NOT NULL")
def token_counts_literals(spark, sf_dir):
    return S.QUESTIONS.frame(spark, sf_dir).where("question IS NOT NULL").select("id", A.token_counts(F.col("question")).alias("n")).select("id", "n.*")


@query(
    f"SELECT conv_id, turn, CASE WHEN NOT {_PII_SQL.format(t='text')} THEN text END AS raw, CASE WHEN {_PII_SQL.format(t='text')} THEN {_anon_sql('text')} END AS anonymized FROM conversations WHERE role = 'user'"
)
def pii_raw_drop(spark, sf_dir):
    raw, anonymized = A.stored_forms(F.col("text"))
    return table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", raw.alias("raw"), anonymized.alias("anonymized"))


@query(f"SELECT id, {_PII_SQL.format(t='question')} AS pii FROM {S.QUESTIONS.sql()} WHERE question IS NOT NULL")
def pii_detect_literals(spark, sf_dir):
    return S.QUESTIONS.frame(spark, sf_dir).where("question IS NOT NULL").select("id", A.has_pii(F.col("question")).alias("pii"))


@query("SELECT conv_id, turn, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS html FROM conversations")
def escape_html(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", A.escape_html(F.col("text")).alias("html"))


@query("SELECT conv_id, turn, 'phase1-police' AS phase, 'data/phase1-police/' || role || '/' || role || '-article-' || turn || '.md' AS path, role || '-art-' || turn AS article_id FROM conversations")
def canonical_path(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    number = F.col("turn").cast("string")
    return c.select("conv_id", "turn", F.lit("phase1-police").alias("phase"), keys.article_path(F.col("role"), number).alias("path"), keys.article_id(F.col("role"), number).alias("article_id"))


@query(
    f"SELECT law_abbrev, article_number, '/repo/data/phase1-police/' || law_abbrev || '/' || law_abbrev || '-article-' || article_number || '.md' AS path, law_abbrev || '-art-' || article_number AS article_id, "
    f"'/repo/data' AS root FROM {S.WANTED.sql()}"
)
def canonical_path_root(spark, sf_dir):
    w = S.WANTED.frame(spark, sf_dir)
    c = F.col
    return w.select("law_abbrev", "article_number", keys.article_path(c("law_abbrev"), c("article_number"), "/repo//./data/").alias("path"), keys.article_id(c("law_abbrev"), c("article_number")).alias("article_id"), F.lit("/repo/data").alias("root"))


@query(
    "SELECT o_orderkey, coalesce(s IN ('official','community','draft','none'), false) AS status_ok, coalesce(r IN ('high','medium','low'), false) AS relevance_ok, "
    "CAST(CASE r WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 0 END AS INTEGER) AS relevance_rank FROM "
    "(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'official' WHEN 'O' THEN 'draft' ELSE o_orderstatus END AS s, lower(substr(o_orderpriority, 3)) AS r FROM orders)"
)
def enum_domain_check(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    s = F.when(F.col("o_orderstatus") == "F", "official").when(F.col("o_orderstatus") == "O", "draft").otherwise(F.col("o_orderstatus"))
    r = F.lower(F.expr("substr(o_orderpriority, 3)"))
    return o.select("o_orderkey", domains.translation_status_ok(s).alias("status_ok"), domains.relevance_ok(r).alias("relevance_ok"), F.coalesce(domains.relevance_rank(r), F.lit(0)).alias("relevance_rank"))


@query(f"SELECT w.law_abbrev, w.article_number, l.law_id, l.phase FROM {S.WANTED.sql()} w LEFT JOIN {S.LAWS.sql()} l ON w.law_abbrev = l.law_abbrev")
def law_lookup(spark, sf_dir):
    return reports.lookup(S.LAWS.frame(spark, sf_dir), S.WANTED.frame(spark, sf_dir)).select("law_abbrev", "article_number", "law_id", "phase")


_PATTERN = "^([1-5])([0-9]{2})(AC|CO|M|CONSTITUTION)[0-9]*$"


@query(
    f"SELECT law_abbrev, CASE e WHEN 1 THEN 'Meiji' WHEN 2 THEN 'Taisho' WHEN 3 THEN 'Showa' WHEN 4 THEN 'Heisei' WHEN 5 THEN 'Reiwa' ELSE '-' END AS era, "
    f"CASE k WHEN 'AC' THEN 'act' WHEN 'CO' THEN 'cabinet order' WHEN 'M' THEN 'ministerial ordinance' WHEN 'CONSTITUTION' THEN 'constitution' ELSE '-' END AS kind, "
    f"CAST(coalesce(CASE e WHEN 1 THEN 1867 WHEN 2 THEN 1911 WHEN 3 THEN 1925 WHEN 4 THEN 1988 WHEN 5 THEN 2018 END + y, 0) AS INTEGER) AS year, 'https://laws.e-gov.go.jp/law/' || law_id AS source_url "
    f"FROM (SELECT *, TRY_CAST(regexp_extract(law_id, '{_PATTERN}', 1) AS INTEGER) AS e, TRY_CAST(regexp_extract(law_id, '{_PATTERN}', 2) AS INTEGER) AS y, regexp_extract(law_id, '{_PATTERN}', 3) AS k FROM {S.LAWS.sql()})"
)
def law_id_decode(spark, sf_dir):
    d = S.LAWS.frame(spark, sf_dir).withColumn("d", keys.law_decode(F.col("law_id")))
    return d.select("law_abbrev", F.coalesce("d.era", F.lit("-")).alias("era"), F.coalesce("d.kind", F.lit("-")).alias("kind"), F.coalesce("d.year", F.lit(0)).alias("year"), keys.source_url(F.col("law_id")).alias("source_url"))


_K = numerals.KANJI


def _kanji_sql(t: str) -> str:
    def unit(sign: str, worth: int) -> str:
        digit = f"regexp_extract({t}, '([{numerals.DIGITS}]?){sign}', 1)"
        return f"CASE WHEN contains({t}, '{sign}') THEN greatest(strpos('{numerals.DIGITS}', nullif({digit}, '')), 1) * {worth} ELSE 0 END"

    last = f"coalesce(strpos('{numerals.DIGITS}', nullif(regexp_extract({t}, '([{numerals.DIGITS}])$', 1), '')), 0)"
    units = " + ".join(f"({unit(s, w)})" for s, w in (("千", 1000), ("百", 100), ("十", 10)))
    return f"CAST(CASE WHEN regexp_matches({t}, '^{_K}+$') THEN {units.replace('greatest(strpos', 'greatest(coalesce(strpos').replace(', 1) *', ', 0), 1) *')} + {last} ELSE -1 END AS INTEGER)"


_kanji_sql_value = _kanji_sql("numeral")


@query(f"SELECT numeral, coalesce({_kanji_sql_value}, -1) AS value FROM {S.NUMERALS.sql()}")
def kanji_to_int(spark, sf_dir):
    return S.NUMERALS.frame(spark, sf_dir).select("numeral", F.coalesce(numerals.kanji_to_int(F.col("numeral")), F.lit(-1)).alias("value"))


@query(
    f"SELECT heading, CASE WHEN regexp_matches(heading, '^第{_K}+条') THEN array_to_string(list_transform(list_concat([regexp_extract(heading, '^第({_K}+)条', 1)], "
    f"regexp_extract_all(regexp_extract(heading, '^第{_K}+条((?:の{_K}+)*)', 1), 'の({_K}+)', 1)), lambda x: CAST({_kanji_sql('x')} AS VARCHAR)), '-') END AS article_number FROM {S.NUMERALS.sql()}"
)
def heading_number(spark, sf_dir):
    return S.NUMERALS.frame(spark, sf_dir).select("heading", numerals.heading_number(F.col("heading"))["article_number"].alias("article_number"))


@query(f"SELECT law_abbrev, article_number, row_number() OVER (PARTITION BY law_abbrev ORDER BY list_transform(string_split(article_number, '-'), lambda x: CAST(x AS INTEGER))) AS place FROM {S.NUMBERS.sql()}")
def natural_sort_rank(spark, sf_dir):
    from pyspark.sql import Window as W

    n = S.NUMBERS.frame(spark, sf_dir)
    return n.select("law_abbrev", "article_number", F.row_number().over(W.partitionBy("law_abbrev").orderBy(keys.natural_key(F.col("article_number")))).cast("long").alias("place"))


_TYPE_SQL = (
    f"CASE WHEN regexp_matches(text, '{clauses.LIST_LEAD}') THEN 'hashira' WHEN contains(text, '{clauses.OVERRIDE}') THEN 'tokusoku' WHEN contains(text, '{clauses.APPLIED}') THEN 'junyou' "
    f"WHEN contains(text, '{clauses.PROVISO}') THEN 'proviso' WHEN text IS NOT NULL THEN 'simple' END"
)
_MODALITY_SQL = "CASE " + " ".join(f"WHEN regexp_matches(text, '(?:{p})。?$') THEN '{n}'" for n, p in clauses.ENDINGS) + " WHEN text IS NOT NULL THEN 'unspecified' END"
_REFS_SQL = f"array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{clauses.RELATIVE}'))), '|')"


@query(f"SELECT article_id, number, {_TYPE_SQL} AS type FROM {S.PARAGRAPHS.sql()}")
def segment_type(spark, sf_dir):
    return S.PARAGRAPHS.frame(spark, sf_dir).select("article_id", "number", clauses.paragraph_type(F.col("text")).alias("type"))


@query(f"SELECT article_id, number, {_MODALITY_SQL} AS modality FROM {S.PARAGRAPHS.sql()}")
def modality(spark, sf_dir):
    return S.PARAGRAPHS.frame(spark, sf_dir).select("article_id", "number", clauses.modality(F.col("text")).alias("modality"))


@query(f"SELECT article_id, number, {_REFS_SQL} AS refs FROM {S.PARAGRAPHS.sql()} WHERE text IS NOT NULL")
def references(spark, sf_dir):
    return S.PARAGRAPHS.frame(spark, sf_dir).where("text IS NOT NULL").withColumn("r", clauses.references(F.col("text"))).select("article_id", "number", joined("r").alias("refs"))


@query(f"SELECT article_id, number, array_to_string(regexp_extract_all(text, '{clauses.PROVISIONS}', 1), '|') AS provisions FROM {S.PARAGRAPHS.sql()} WHERE {_TYPE_SQL} = 'junyou'")
def applies_provisions(spark, sf_dir):
    rows = S.PARAGRAPHS.frame(spark, sf_dir).withColumn("p", clauses.applies_provisions(F.col("text"))).where("p IS NOT NULL")
    return rows.select("article_id", "number", joined("p").alias("provisions"))


@query(f"SELECT article_id, number, regexp_extract(text, '{clauses.TARGET}', 1) AS target FROM {S.PARAGRAPHS.sql()} WHERE {_TYPE_SQL} = 'tokusoku'")
def override_target(spark, sf_dir):
    return S.PARAGRAPHS.frame(spark, sf_dir).select("article_id", "number", clauses.override_target(F.col("text")).alias("target")).where("target IS NOT NULL")


_SPLIT_SQL = (
    f"SELECT article_id, number, unnest(CASE WHEN k = 'proviso' THEN [{{'t': 'honbun', 'x': substr(text, 1, strpos(text, '{clauses.PROVISO}'))}}, {{'t': 'tadashi', 'x': substr(text, strpos(text, '{clauses.PROVISO}') + 1)}}] "
    f"ELSE [{{'t': k, 'x': text}}] END) AS s FROM (SELECT *, {_TYPE_SQL} AS k FROM {S.PARAGRAPHS.sql()}) WHERE text IS NOT NULL"
)


@query(f"SELECT article_id, number, s.t AS type, s.x AS text FROM ({_SPLIT_SQL})")
def proviso_split(spark, sf_dir):
    return S.PARAGRAPHS.frame(spark, sf_dir).select("article_id", "number", F.explode(clauses.split_proviso(F.col("text"))).alias("s")).select("article_id", "number", "s.type", "s.text")


@query(
    f"SELECT article_id || '-p' || number || CASE WHEN type IN ('hashira','honbun','tadashi') THEN '-' || type ELSE '' END AS id, type, {_MODALITY_SQL} AS modality, {_REFS_SQL} AS refs "
    f"FROM (SELECT article_id, number, s.t AS type, s.x AS text FROM ({_SPLIT_SQL}))"
)
def segments(spark, sf_dir):
    return structure.segments(S.PARAGRAPHS.frame(spark, sf_dir)).select("id", "type", "modality", joined("references").alias("refs"))


@query(
    f"WITH s AS (SELECT article_id || '-p' || number || CASE WHEN type IN ('hashira','honbun','tadashi') THEN '-' || type ELSE '' END AS id, type, text FROM (SELECT article_id, number, s.t AS type, s.x AS text FROM ({_SPLIT_SQL}))) "
    f"SELECT id, 'refers' AS relation, unnest(list_distinct(regexp_extract_all(text, '{clauses.RELATIVE}'))) AS target FROM s "
    f"UNION ALL SELECT id, 'applies', unnest(regexp_extract_all(text, '{clauses.PROVISIONS}', 1)) FROM s WHERE type = 'junyou' "
    f"UNION ALL SELECT id, 'overrides', regexp_extract(text, '{clauses.TARGET}', 1) FROM s WHERE type = 'tokusoku' AND regexp_matches(text, '{clauses.TARGET}')"
)
def citation_edges(spark, sf_dir):
    return citations.edges(structure.segments(S.PARAGRAPHS.frame(spark, sf_dir)))


_ADJACENT_SQL = (
    f"WITH i AS (SELECT law_abbrev, article_number, row_number() OVER (PARTITION BY law_abbrev ORDER BY list_transform(string_split(article_number, '-'), lambda x: CAST(x AS INTEGER))) AS place FROM {S.NUMBERS.sql()} WHERE complete), "
    f"p AS (SELECT p.*, i.place, CASE target WHEN '前条' THEN 1 WHEN '前二条' THEN 2 WHEN '前三条' THEN 3 END AS many FROM {S.PHRASES.sql()} p LEFT JOIN i USING (law_abbrev, article_number)), "
    f"r AS (SELECT *, CASE WHEN many IS NOT NULL THEN place - many WHEN target = '次条' THEN place + 1 WHEN target = '本条' THEN place END AS low, CASE WHEN many IS NOT NULL THEN place - 1 WHEN target = '次条' THEN place + 1 WHEN target = '本条' THEN place END AS high FROM p), "
    f"f AS (SELECT r.\"row\" AS rid, string_agg(i.article_number, '|' ORDER BY i.place) AS t, count(*) AS n FROM r JOIN i ON i.law_abbrev = r.law_abbrev AND i.place BETWEEN r.low AND r.high GROUP BY r.\"row\") "
    f"SELECT r.law_abbrev, r.article_number, r.target, CASE WHEN f.n = r.high - r.low + 1 THEN f.t ELSE '' END AS targets, coalesce(f.n = r.high - r.low + 1, false) AS resolved FROM r LEFT JOIN f ON f.rid = r.\"row\""
)


@query(_ADJACENT_SQL)
def adjacency_resolution(spark, sf_dir):
    found = citations.resolve(S.PHRASES.frame(spark, sf_dir), S.NUMBERS.frame(spark, sf_dir))
    return found.select("law_abbrev", "article_number", "target", joined("targets").alias("targets"), "resolved")


@query(
    f"WITH RECURSIVE e AS (SELECT DISTINCT law_abbrev || ' ' || article_number AS source, law_abbrev || ' ' || unnest(string_split(targets, '|')) AS target FROM ({_ADJACENT_SQL}) WHERE resolved), "
    "r(source, target, depth) AS (SELECT source, target, 1 FROM e UNION SELECT r.source, e.target, r.depth + 1 FROM r JOIN e ON e.source = r.target WHERE r.depth < 16), "
    "c AS (SELECT source, target, min(depth) AS depth FROM r GROUP BY ALL) "
    "SELECT c.source, c.target, c.depth, b.source IS NOT NULL AS cyclic FROM c LEFT JOIN c b ON b.source = c.target AND b.target = c.source"
)
def citation_closure(spark, sf_dir):
    """All articles that an article leads to by its references and theirs."""
    found = citations.resolve(S.PHRASES.frame(spark, sf_dir), S.NUMBERS.frame(spark, sf_dir)).where("resolved")
    of = lambda number: F.concat_ws(" ", "law_abbrev", number)
    edges = found.select(of("article_number").alias("source"), "law_abbrev", F.explode("targets").alias("to")).select("source", of("to").alias("target"))
    return closure.closure(edges)[0]


@query(
    f"SELECT coalesce(o.article_id, n.article_id) AS article_id, CASE WHEN o.article_id IS NULL THEN 'added' WHEN n.article_id IS NULL THEN 'removed' WHEN o.law_name IS DISTINCT FROM n.law_name OR o.body IS DISTINCT FROM n.body "
    f"OR o.tag IS DISTINCT FROM n.tag THEN 'changed' ELSE 'same' END AS status, CASE WHEN o.article_id IS NULL OR n.article_id IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN o.law_name IS DISTINCT FROM n.law_name THEN 'law_name' END, "
    f"CASE WHEN o.body IS DISTINCT FROM n.body THEN 'body' END, CASE WHEN o.tag IS DISTINCT FROM n.tag THEN 'tag' END], lambda x: x IS NOT NULL), '|') END AS changed FROM {S.OLD.sql()} o FULL OUTER JOIN {S.NEW.sql()} n ON o.article_id = n.article_id"
)
def version_diff(spark, sf_dir):
    return versions.diff(S.OLD.frame(spark, sf_dir), S.NEW.frame(spark, sf_dir)).select("article_id", "status", joined("changed").alias("changed"))


@query(f"SELECT * FROM {S.OLD.sql()} o WHERE NOT EXISTS (SELECT 1 FROM {S.NEW.sql()} n WHERE n.article_id = o.article_id)")
def only_in_old(spark, sf_dir):
    return versions.only_in(S.OLD.frame(spark, sf_dir), S.NEW.frame(spark, sf_dir))


@query(f"SELECT * FROM {S.OLD.sql()} o WHERE EXISTS (SELECT 1 FROM {S.NEW.sql()} n WHERE n.article_id = o.article_id)")
def in_both_tiers(spark, sf_dir):
    return versions.in_both(S.OLD.frame(spark, sf_dir), S.NEW.frame(spark, sf_dir))


@query(f"SELECT article_id FROM {S.OLD.sql()} EXCEPT ALL SELECT article_id FROM {S.NEW.sql()}")
def tier_except(spark, sf_dir):
    return versions.keys_except(S.OLD.frame(spark, sf_dir), S.NEW.frame(spark, sf_dir))


@query(f"SELECT article_id FROM {S.OLD.sql()} INTERSECT SELECT article_id FROM {S.NEW.sql()}")
def tier_intersect(spark, sf_dir):
    return versions.keys_common(S.OLD.frame(spark, sf_dir), S.NEW.frame(spark, sf_dir))


@query(f"SELECT 'old' AS tier, article_id, law_name, body, CAST(NULL AS VARCHAR) AS tag FROM {S.OLD.sql()} UNION ALL SELECT 'new', article_id, law_name, body, tag FROM {S.NEW.sql()}")
def tier_union(spark, sf_dir):
    old, new = S.OLD.frame(spark, sf_dir).drop("tag").withColumn("tier", F.lit("old")), S.NEW.frame(spark, sf_dir).withColumn("tier", F.lit("new"))
    return versions.union(old, new).select("tier", "article_id", "law_name", "body", "tag")


@query(f"SELECT law_abbrev, array_to_string(list_sort(list(DISTINCT phase)), '|') AS phases FROM {S.MEMBERS.sql()} GROUP BY law_abbrev HAVING count(DISTINCT phase) > 1")
def duplicate_key_report(spark, sf_dir):
    return integrity.duplicate_keys(S.MEMBERS.frame(spark, sf_dir)).select("law_abbrev", joined("phases").alias("phases"))


@query(f"SELECT law_abbrev, path FROM {S.MEMBERS.sql()} WHERE law_id IS NULL")
def missing_key_report(spark, sf_dir):
    return integrity.missing_keys(S.MEMBERS.frame(spark, sf_dir))


@query(f"SELECT law_abbrev, min(law_id) AS law_id, min(phase) AS phase, count(*) AS n_articles, min(version_date) AS version_date, max(last_verified) AS last_verified FROM {S.MEMBERS.sql()} WHERE law_abbrev LIKE 'alpha-%' OR law_abbrev LIKE 'beta-%' GROUP BY law_abbrev")
def manifest(spark, sf_dir):
    return integrity.guarded_manifest(S.MEMBERS.frame(spark, sf_dir).where(F.col("law_abbrev").rlike("^(alpha|beta)-")))


@query(f"SELECT coalesce(hen, -1) AS hen, coalesce(shou, -1) AS shou, coalesce(setsu, -1) AS setsu, CAST(GROUPING(hen) * 4 + GROUPING(shou) * 2 + GROUPING(setsu) AS INTEGER) AS level, count(*) AS n FROM {S.SECTIONS.sql()} GROUP BY ROLLUP (hen, shou, setsu)")
def section_rollup(spark, sf_dir):
    found = reports.section_rollup(S.SECTIONS.frame(spark, sf_dir))
    return found.select(*(F.coalesce(c, F.lit(-1)).alias(c) for c in ("hen", "shou", "setsu")), "level", "n")


@query(
    f"SELECT article_id, CASE WHEN shou_name IS NULL THEN '' ELSE array_to_string(list_transform(list_concat([regexp_extract(shou_name, '^第({_K}+)章', 1)], regexp_extract_all(regexp_extract(shou_name, '^第{_K}+章((?:の{_K}+)*)', 1), 'の({_K}+)', 1)), "
    f"lambda x: CAST({_kanji_sql('x')} AS VARCHAR)), '-') END AS chapter FROM {S.SECTIONS.sql()}"
)
def section_order(spark, sf_dir):
    return S.SECTIONS.frame(spark, sf_dir).withColumn("k", numerals.section_key(F.col("shou_name"), "shou")).select("article_id", F.concat_ws("-", F.col("k").cast("array<string>")).alias("chapter"))


_FM = "split_part(value, E'\\n---\\n', 1)"


@query(
    "SELECT path, " + ", ".join(f"nullif(regexp_replace(regexp_extract({_FM}, '(?m)^{k}: (.+)$', 1), '^[''\"](.*)[''\"]$', '\\1'), '') AS {k}" for k in ("law_id", "law_name_ja", "article_number", "article_id", "version_date", "translation_status")) + f" FROM {S.DOCUMENTS.sql()}"
)
def frontmatter_flat(spark, sf_dir):
    names = ("law_id", "law_name_ja", "article_number", "article_id", "version_date", "translation_status")
    return S.DOCUMENTS.frame(spark, sf_dir).select("path", *(files.flat_field(F.col("value"), k).alias(k) for k in names))


# The oracles of whole articles read the front matter line by line, which the sample's files allow.
def _field_sql(k: str) -> str:
    return f"nullif(regexp_replace(regexp_extract(front, '(?m)^{k}: (.+)$', 1), '^[''\"](.*)[''\"]$', '\\1'), '')"


_TREE = S.DOCUMENTS.over("supplier", "s_suppkey")
_PATH = r"([^/]+)/(?:(phase[0-9]+-[a-z]+)/)?([a-z0-9-]+)/([a-z0-9-]+)-article-([0-9-]+)\.md$"
_FIELDS = ("law_id", "article_number", "article_id", "version_date", "source_url", "last_verified", "translation_status", "machine_translated")
def _articles_sql(rows: str) -> str:
    return (
        "(SELECT path, value, corrupt, body, front, tier, law_abbrev, tag, coalesce(phase, tag) AS phase, numbers, len(numbers) AS n, " + ", ".join(f"{_field_sql(k)} AS {k}" for k in _FIELDS)
        + f" FROM (SELECT *, nullif(regexp_extract(path, '{_PATH}', 1), '') AS tier, nullif(regexp_extract(path, '{_PATH}', 2), '') AS phase, nullif(regexp_extract(path, '{_PATH}', 3), '') AS law_abbrev, "
        "nullif(regexp_extract(front, '(?m)^tags:\\n- (.+)$', 1), '') AS tag, regexp_extract_all(front, '(?m)^- number: (.+)$', 1) AS numbers FROM (SELECT *, CASE WHEN corrupt IS NULL THEN split_part(value, E'\\n---\\n', 1) END AS front, "
        "CASE WHEN corrupt IS NULL THEN substr(value, strpos(value, E'\\n---\\n') + 5) END AS body FROM (SELECT *, CASE WHEN NOT starts_with(value, E'---\\n') THEN 'no front matter' "
        f"WHEN NOT contains(value, E'\\n---\\n') THEN 'front matter does not end' END AS corrupt FROM {rows}))))"
    )


_ARTICLES_SQL = _articles_sql(S.DOCUMENTS.sql())


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_RULES = {
    "V1": f"len(list_filter([{_names(schema.REQUIRED_KEYS)}], lambda k: NOT regexp_matches(front, '(?m)^' || k || ':'))) > 0",
    "V2": "article_id IS DISTINCT FROM law_abbrev || '-art-' || article_number",
    "V3": "NOT coalesce(ends_with(path, '/' || law_abbrev || '/' || law_abbrev || '-article-' || article_number || '.md'), false)",
    "V4": f"source_url IS DISTINCT FROM '{schema.SOURCE_BASE}' || law_id",
    "V5": r"NOT coalesce(regexp_matches(law_id, '^\d{3}(AC\d{10}|CO\d{10}|M\d{11}|CONSTITUTION)$'), false)",
    "V6": "TRY_CAST(version_date AS DATE) IS NULL OR TRY_CAST(last_verified AS DATE) IS NULL",
    "V7": "array_to_string(numbers, ',') <> array_to_string(range(1, n + 1), ',')",
    "V8": "len(regexp_extract_all(body, '(?m)^### ')) <> n",
    "V9": f"coalesce(translation_status NOT IN ({_names(schema.TRANSLATION_STATUS)}), true)",
    "V10": f"len(list_filter(regexp_extract_all(front, '(?m)^    type: (.+)$', 1), lambda x: x NOT IN ({_names(schema.SEGMENT_TYPES)}))) + len(list_filter(regexp_extract_all(front, '(?m)^    modality: (.+)$', 1), lambda x: x NOT IN ({_names(schema.MODALITIES)}))) > 0",
    "V11": "phase IS DISTINCT FROM tag",
    "V12": "len(list_filter(string_split(front, E'\\n- number: ')[2:], lambda p: contains(p, E'\\n  - id: ') AND (contains(p, 'type: hashira') <> contains(p, 'has_items: true') OR contains(p, 'type: tadashi') <> contains(p, 'has_proviso: true')))) > 0",
}
def _found_sql(articles: str) -> str:
    return (
        "(SELECT *, CASE WHEN corrupt IS NOT NULL THEN ['V0'] ELSE list_filter([" + ", ".join(f"CASE WHEN {bad} THEN '{code}' END" for code, bad in _RULES.items())
        + f"], lambda x: x IS NOT NULL) END AS found FROM {articles})"
    )


_FOUND_SQL, _TREE_SQL = _found_sql(_ARTICLES_SQL), _found_sql(_articles_sql(_TREE.sql()))


@query(
    "SELECT path, tier, phase, law_abbrev, article_number, CASE WHEN corrupt IS NULL THEN CAST(n AS INTEGER) END AS n_paragraphs, nullif(regexp_extract(front, '(?m)^  shou_name_ja: (.+)$', 1), '') AS shou_name_ja, "
    f"machine_translated = 'true' AS machine_translated, corrupt FROM {_ARTICLES_SQL}"
)
def frontmatter_parse(spark, sf_dir):
    return files.parse(S.DOCUMENTS.frame(spark, sf_dir)).select("path", "tier", "phase", "law_abbrev", "article_number", F.size("paragraphs").alias("n_paragraphs"), "parent_section.shou_name_ja", "machine_translated", "corrupt")


@query(f"SELECT path, array_to_string(found, '|') AS violations, len(found) = 0 AS ok FROM {_FOUND_SQL}")
def validation_report(spark, sf_dir):
    return integrity.validate(files.parse(S.DOCUMENTS.frame(spark, sf_dir))).select("path", joined("violations").alias("violations"), "ok")


@query(f"SELECT rule, count(*) AS n FROM (SELECT unnest(CASE WHEN len(found) = 0 THEN ['OK'] ELSE found END) AS rule FROM {_FOUND_SQL}) GROUP BY rule")
def quality_report(spark, sf_dir):
    return reports.quality(files.parse(S.DOCUMENTS.frame(spark, sf_dir)))


@query(
    f"SELECT article_id, number, heading, text, CASE WHEN regexp_matches(heading, '^第{_K}+条') THEN array_to_string(list_transform(list_concat([regexp_extract(heading, '^第({_K}+)条', 1)], "
    f"regexp_extract_all(regexp_extract(heading, '^第{_K}+条((?:の{_K}+)*)', 1), 'の({_K}+)', 1)), lambda x: CAST({_kanji_sql('x')} AS VARCHAR)), '-') END AS named, "
    "len(string_split(article_number, '-')) - 1 <= CASE WHEN last_verified = '2026-06-01' THEN 1 ELSE 0 END AS covered FROM (SELECT article_id, article_number, last_verified, CAST(k - 1 AS INTEGER) AS number, "
    "regexp_extract(part, '^[^\\n]*') AS heading, trim(regexp_replace(regexp_replace(part, '^[^\\n]*\\n?', ''), '<!-- segment: [^>]*-->\\n?', '', 'g'), E'\\n ') AS text FROM "
    f"(SELECT *, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM (SELECT *, string_split_regex(body, '(?m)^### ') AS parts FROM {_ARTICLES_SQL})) WHERE k > 1)"
)
def body_paragraphs(spark, sf_dir):
    rows = structure.paragraphs(files.parse(S.DOCUMENTS.frame(spark, sf_dir)))
    covered = structure.covered(F.col("article_number"), F.col("last_verified"))
    return rows.select("article_id", "number", "heading", "text", F.col("named.article_number").alias("named"), covered.alias("covered"))


@query(f"SELECT tier || '/' || phase || '/' || law_abbrev || '/' || law_abbrev || '-article-' || article_number || '.md' AS path, value FROM {_ARTICLES_SQL} WHERE corrupt IS NULL")
def rendered_articles(spark, sf_dir):
    return files.render(files.parse(S.DOCUMENTS.frame(spark, sf_dir)).where("corrupt IS NULL"))


def _sample_tree(spark, sf_dir: str) -> str:
    """Article files, one for each supplier, written as files by the tasks; the shared folder has to be mounted by all executors."""
    at = scratch(spark, "articles")
    rows = _TREE.frame(spark, sf_dir).select(F.regexp_extract("path", "^file:/x/(.*)$", 1).alias("path"), "value")
    files.write_files(rows, at, mounted=at.startswith(("file:", "/")))
    return at


_BELOW = r"(t1/.*)$"


@query(f"SELECT regexp_extract(path, '{_BELOW}', 1) AS path, array_to_string(found, '|') AS violations, len(found) = 0 AS ok FROM {_TREE_SQL}")
def article_files(spark, sf_dir):
    found = integrity.validate(files.read_articles(spark, _sample_tree(spark, sf_dir)))
    return found.select(F.regexp_extract("path", _BELOW, 1).alias("path"), joined("violations").alias("violations"), "ok")


@query(
    "SELECT law_abbrev, min(law_id) AS law_id, min(phase) AS phase, count(*) AS n_articles, min(version_date) AS version_date, max(last_verified) AS last_verified "
    f"FROM {_TREE_SQL} WHERE len(found) = 0 GROUP BY law_abbrev"
)
def article_files_manifest(spark, sf_dir):
    articles = files.read_articles(spark, _sample_tree(spark, sf_dir))
    return integrity.guarded_manifest(articles.where(F.size(integrity.violations()) == 0))


@query(
    f"SELECT id, CAST(line - 1 AS INTEGER) AS line, CAST(place - 1 AS INTEGER) AS place, trim(cell) AS cell FROM (SELECT id, line, unnest(cells) AS cell, generate_subscripts(cells, 1) AS place FROM "
    f"(SELECT id, line, string_split(substr(content, 2, length(content) - 2), '|') AS cells FROM (SELECT id, unnest(string_split(text, E'\\n')) AS content, generate_subscripts(string_split(text, E'\\n'), 1) AS line FROM {S.TABLES.sql()}) "
    f"WHERE content LIKE '|%|' AND length(content) > 1 AND translate(content, ' :|-', '') <> ''))"
)
def table_cells(spark, sf_dir):
    return structure.table_cells(S.TABLES.frame(spark, sf_dir), "text", "id").withColumnRenamed("column", "place")


# What Python's cp932 can write, but never reads.
_ONE_WAY = "¢£¬‖−〜"


def _charset_class(charset: str) -> str:
    """What a charset can hold, as the inside of a character class, from all that its bytes can say; control characters are left out."""
    said = {_ONE_WAY} | {bytes([a]).decode(charset, "ignore") for a in range(256)} | {bytes([a, b]).decode(charset, "ignore") for a in range(128, 256) for b in range(256)}
    runs: list[list[int]] = []
    for c in sorted(ord(c) for text in said for c in text if ord(c) >= 32):
        if runs and c <= runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)


_UNSAFE = rf"[^\x00-\x1f{_charset_class('cp932')}]"


@query(f"SELECT id, array_to_string(list_sort(list_distinct(regexp_extract_all(question, '{_UNSAFE}'))), '') AS unsafe FROM {S.QUESTIONS.sql()}")
def encoding_safety(spark, sf_dir):
    return safety.check_encoding(S.QUESTIONS.frame(spark, sf_dir), "question").select("id", "unsafe")


@query(f"SELECT NOT regexp_matches(text, '{_UNSAFE}') AS safe, count(*) AS n FROM documents GROUP BY ALL")
def encoding_safety_documents(spark, sf_dir):
    return safety.check_encoding(table(spark, sf_dir, "documents"), "text").groupBy("safe").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT 'phase' || number || '-mihon' AS phase, regexp_replace(article_id, '-art-.*$', '') AS law_abbrev, {_MODALITY_SQL} AS modality, count(*) AS n FROM (SELECT article_id, number, s.t AS type, s.x AS text FROM ({_SPLIT_SQL})) GROUP BY ALL")
def modality_distribution(spark, sf_dir):
    rows = structure.segments(S.PARAGRAPHS.frame(spark, sf_dir)).withColumns({"phase": F.concat(F.lit("phase"), "number", F.lit("-mihon")), "law_abbrev": F.regexp_replace("article_id", "-art-.*$", "")})
    return reports.modality_by_law(rows).select("phase", "law_abbrev", "modality", "n")


@query(f"SELECT tier, article_id, count(*) AS n FROM (SELECT 'old' AS tier, article_id FROM {S.OLD.sql()} UNION ALL SELECT 'old', article_id FROM {S.NEW.sql()} UNION ALL SELECT 'new', article_id FROM {S.NEW.sql()}) GROUP BY ALL HAVING count(*) > 1")
def repeated_ids(spark, sf_dir):
    of = lambda sample, tier: sample.frame(spark, sf_dir).select(F.lit(tier).alias("tier"), "article_id")
    return integrity.repeated_ids(of(S.OLD, "old").unionByName(of(S.NEW, "old")).unionByName(of(S.NEW, "new")))


@query(f"SELECT conv_id, turn, CASE WHEN NOT {_PII_SQL.format(t='text')} THEN text END AS raw, CASE WHEN {_PII_SQL.format(t='text')} THEN {_anon_sql('text')} END AS anonymized FROM conversations")
def question_stream(spark, sf_dir):
    at = scratch(spark, "questions")
    rows = stream.source(spark, sf_dir, "conversations.parquet").select("conv_id", "turn", F.col("text").alias("question"))
    stream.run_available(stream.anonymized(rows), f"{at}/log", f"{at}/state")
    return spark.read.parquet(f"{at}/log").select("conv_id", "turn", "raw", "anonymized")


@query(f"SELECT law_abbrev, phase || '|auto-generated' AS tags FROM {S.LAWS.sql()}")
def default_tags(spark, sf_dir):
    return S.LAWS.frame(spark, sf_dir).withColumn("t", keys.default_tags(F.col("phase"))).select("law_abbrev", joined("t").alias("tags"))


@query(f"SELECT article_id, number, bool_or(s.t = 'hashira') AS has_items, bool_or(s.t = 'tadashi') AS has_proviso FROM ({_SPLIT_SQL}) GROUP BY article_id, number")
def paragraph_flags(spark, sf_dir):
    rows = S.PARAGRAPHS.frame(spark, sf_dir).where("text IS NOT NULL").withColumn("f", structure.flags(clauses.split_proviso(F.col("text"))))
    return rows.select("article_id", "number", "f.*")


@query(
    f"WITH s AS (SELECT article_id || '-p' || number || CASE WHEN type IN ('hashira','honbun','tadashi') THEN '-' || type ELSE '' END AS id, type, text, regexp_extract_all(text, '{clauses.PROVISIONS}', 1) AS p, regexp_extract(text, '{clauses.TARGET}', 1) AS o "
    f"FROM (SELECT article_id, number, s.t AS type, s.x AS text FROM ({_SPLIT_SQL}))) SELECT id, '<!-- segment: ' || type || ' id: ' || id || CASE WHEN type = 'junyou' AND len(p) > 0 THEN ' applies_provisions: ' || array_to_string(p, ',') ELSE '' END "
    f"|| CASE WHEN type = 'tokusoku' THEN ' override_flag: true' || CASE WHEN o <> '' THEN ' override_target: ' || o ELSE '' END ELSE '' END || ' -->' || chr(10) || text AS marked FROM s"
)
def segment_markers(spark, sf_dir):
    rows = S.PARAGRAPHS.frame(spark, sf_dir).select(F.explode(clauses.segments(F.col("article_id"), F.col("number"), F.col("text"))).alias("s"))
    return rows.select("s.id", structure.marked(F.col("s")).alias("marked"))


@query(f"SELECT id, nullif(regexp_extract(regexp_replace(body, '<!-- segment: [^>]*-->\\n?', '', 'g'), '(?m)^# .*第[0-9-]+条\\(（(.*)）\\)', 1), '') AS caption, len(string_split(article_number, '-')) - 1 <= CASE WHEN last_verified = '2026-06-01' THEN 1 ELSE 0 END AS covered FROM {S.BODIES.sql()}")
def captions_and_coverage(spark, sf_dir):
    c = F.col
    return S.BODIES.frame(spark, sf_dir).select("id", structure.caption(c("body")).alias("caption"), structure.covered(c("article_number"), c("last_verified")).alias("covered"))


@query(f"SELECT article_id, number, trim(text) = '削除' AS repealed FROM {S.PARAGRAPHS.sql()} WHERE text IS NOT NULL")
def repealed(spark, sf_dir):
    return S.PARAGRAPHS.frame(spark, sf_dir).where("text IS NOT NULL").select("article_id", "number", clauses.is_repealed(F.col("text")).alias("repealed"))


@query(f"SELECT a.article_id, coalesce(string_agg(d.kind || ':' || d.title, '|' ORDER BY d.kind, d.title), '') AS details FROM {S.OLD.sql()} a LEFT JOIN {S.DETAILS.sql()} d ON d.article_id = a.article_id GROUP BY a.article_id")
def attach_details(spark, sf_dir):
    rows = details.attach(S.OLD.frame(spark, sf_dir), S.DETAILS.frame(spark, sf_dir), "found")
    return rows.select("article_id", F.concat_ws("|", F.transform("found", lambda d: F.concat(d["kind"], F.lit(":"), d["title"]))).alias("details"))
