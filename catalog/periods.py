"""Themes and period reports."""

from pyspark.sql import functions as F

from briefwright.functions import markdown as M
from briefwright.lexicon import Lexicon
from briefwright.operators import aggregates as A, themes as H
from briefwright.plans import periods as P
from briefwright.plans.reports import numbered
from briefwright.session import cut_lineage
from catalog.base import _list, items, query, table, with_items
from catalog.scalars import entity_sql, keywords_sql

L = Lexicon()
SQ = lambda x, n: f"substr(trim(regexp_replace({x}, '\\s+', ' ', 'g')), 1, {n})"
TERMS = (f"cut AS MATERIALIZED (SELECT * REPLACE ({SQ('title', 220)} AS title, {SQ('content', 400)} AS content) FROM items), "
         "ents AS (SELECT item_id, names FROM " + entity_sql("title || ' ' || array_to_string(tags, ' ')").replace("FROM items)", "FROM cut)") + "), "
         f"terms AS MATERIALIZED (SELECT cut.*, {keywords_sql(chr(40) + 'title || chr(32) || content || chr(32) || array_to_string(tags, chr(32))' + chr(41))} AS kws, names FROM cut JOIN ents USING (item_id)), "
         "ec AS MATERIALIZED (SELECT dt, term, count(*) AS o, count(DISTINCT source) AS s FROM (SELECT dt, source, unnest(names) AS term FROM terms) GROUP BY dt, term), "
         "kc AS MATERIALIZED (SELECT dt, term, count(*) AS o, count(DISTINCT source) AS s FROM (SELECT dt, source, unnest(kws) AS term FROM terms) GROUP BY dt, term), "
         "er AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY o + 2 * s DESC, length(term) DESC, lower(term), term) AS r FROM ec WHERE o >= 2 AND (s >= 2 OR o >= 4) QUALIFY r <= 24), "
         "kr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY o + 2 * s DESC, length(term) DESC, lower(term), term) AS r FROM kc WHERE o >= 2 AND (s >= 2 OR o >= 4) AND NOT EXISTS (SELECT 1 FROM er WHERE er.dt = kc.dt AND lower(er.term) = lower(kc.term)) QUALIFY r <= 24)")


def days(spark, sf):
    return items(spark, sf)


@query("wn09_term_rank", with_items("SELECT dt, 'entity' AS kind, term, CAST(r AS BIGINT) AS term_rank FROM er UNION ALL SELECT dt, 'keyword', term, r + (SELECT count(*) FROM er WHERE er.dt = kr.dt) FROM kr", TERMS))
def term_rank(spark, sf):
    t = cut_lineage(H.with_terms(days(spark, sf), L))
    ranks = H.rank_terms(A.term_source_counts(t, "entity_names", ["dt"]), A.term_source_counts(t, "keywords", ["dt"]), ["dt"])
    return ranks.select("dt", "kind", "term", "term_rank")


@query("ag15_keyword_source_counts", with_items("SELECT dt, term, CAST(o AS BIGINT) AS occurrences, s AS sources FROM kc", TERMS))
def keyword_counts(spark, sf):
    return A.term_source_counts(H.with_terms(days(spark, sf), L), "keywords", ["dt"])


KEPT = (TERMS + r", kept AS MATERIALIZED (SELECT * FROM (SELECT *, lower(trim(regexp_replace(regexp_replace(substr(title, 1, 200), 'https?://\S+', '', 'g'), '[`*_>#]', '', 'g'))) AS norm FROM terms) WHERE norm <> ''"
        " QUALIFY row_number() OVER (PARTITION BY dt, norm ORDER BY score DESC, length(title), pos) = 1), short AS MATERIALIZED (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY dt ORDER BY score DESC, length(title), pos) <= 180),"
        " tops AS (SELECT dt, lower(term) AS low FROM er WHERE r <= 24 UNION SELECT dt, lower(term) FROM kr WHERE r + (SELECT count(*) FROM er WHERE er.dt = kr.dt) <= 24),"
        " by_e AS (SELECT q.dt, q.pos, q.term FROM (SELECT dt, pos, unnest(list_distinct(names)) AS term FROM short) q JOIN ec USING (dt, term) WHERE EXISTS (SELECT 1 FROM er WHERE er.dt = q.dt AND er.r <= 16 AND lower(er.term) = lower(q.term))"
        " QUALIFY row_number() OVER (PARTITION BY q.dt, q.pos ORDER BY o + 2 * s DESC, lower(q.term), q.term) = 1),"
        " by_k AS (SELECT q.dt, q.pos, q.term FROM (SELECT dt, pos, unnest(list_distinct(kws)) AS term FROM short) q JOIN kc USING (dt, term) WHERE EXISTS (SELECT 1 FROM tops WHERE tops.dt = q.dt AND low = lower(q.term))"
        " QUALIFY row_number() OVER (PARTITION BY q.dt, q.pos ORDER BY o + 2 * s DESC, lower(q.term), q.term) = 1),"
        " themed AS MATERIALIZED (SELECT short.*, coalesce(by_e.term, by_k.term, source) AS theme FROM short LEFT JOIN by_e USING (dt, pos) LEFT JOIN by_k USING (dt, pos)),"
        " best AS (SELECT *, row_number() OVER (PARTITION BY dt, theme ORDER BY score DESC, length(title), pos) AS item_rank FROM themed QUALIFY item_rank <= 8),"
        " rolled AS (SELECT t.dt, t.theme, n, v, w, f FROM (SELECT dt, theme, count(*) AS n, count(DISTINCT source) AS v, min({'s': -score, 'l': length(title), 'p': pos}) AS f FROM themed GROUP BY dt, theme) t JOIN (SELECT dt, theme, sum(CAST(score AS DECIMAL(28, 6))) AS w FROM best GROUP BY dt, theme) b ON t.dt = b.dt AND t.theme = b.theme),"
        " themes AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY v DESC, n DESC, w DESC, f) AS theme_rank FROM rolled QUALIFY theme_rank <= 12)")


@query("wn10_theme_assignment", with_items("SELECT dt, pos, theme FROM themed", KEPT))
def theme_assignment(spark, sf):
    t = cut_lineage(H.with_terms(days(spark, sf), L))
    e, k = (cut_lineage(A.term_source_counts(t, x, ["dt"])) for x in ("entity_names", "keywords"))
    return H.assign_themes(H.representative_items(t, 180, ["dt"]), H.rank_terms(e, k, ["dt"]), e, k, ["dt"]).select("dt", "pos", "theme")


def themes(spark, sf):
    return H.monthly_themes(days(spark, sf), ["dt"], L)


@query("ag24_theme_rollup", with_items("SELECT dt, theme, n, v AS source_variety, CAST(theme_rank AS INT) AS theme_rank FROM themes", KEPT))
def theme_rollup(spark, sf):
    return themes(spark, sf)["themes"].select("dt", "theme", "n", "source_variety", "theme_rank")


@query("cl03_theme_clustering", with_items("SELECT dt, theme, theme_rank, item_rank, pos FROM best JOIN themes USING (dt, theme)", KEPT))
def theme_clustering(spark, sf):
    return themes(spark, sf)["items"].select("dt", "theme", "theme_rank", "item_rank", "pos")


@query("wn11_theme_top_items", with_items("SELECT dt, pos FROM best JOIN themes USING (dt, theme) WHERE theme_rank <= 12 AND item_rank <= 8", KEPT))
def theme_items(spark, sf):
    return themes(spark, sf)["items"].select("dt", "pos")


@query("wn15_top_cases", with_items("SELECT dt, theme, pos FROM best JOIN themes USING (dt, theme) WHERE theme_rank <= 5 AND item_rank <= 2", KEPT))
def top_cases(spark, sf):
    return H.top_cases(themes(spark, sf)["items"]).select("dt", "theme", "pos")


@query("wn15_reading_list", with_items("SELECT dt, pos FROM (SELECT dt, pos, theme_rank, item_rank FROM best JOIN themes USING (dt, theme) QUALIFY row_number() OVER (PARTITION BY dt, CASE WHEN url <> '' THEN url ELSE title END ORDER BY theme_rank, item_rank) = 1) QUALIFY row_number() OVER (PARTITION BY dt ORDER BY theme_rank, item_rank) <= 8", KEPT))
def reading(spark, sf):
    return H.reading_list(themes(spark, sf)["items"], ["dt"]).select("dt", "pos")


def monthly(spark, sf):
    rows = days(spark, sf).withColumn("month", F.date_format(F.add_months("published_at", F.dayofmonth("published_at")), "yyyy-MM"))
    return rows, *P.period_meta(rows, "month", L)


@query("rp14_batch_summary_lines", with_items("SELECT dt, CAST((theme_rank - 1) // 4 + 1 AS INT) AS batch, theme || '：' || n || ' 条，代表项：' || title AS line FROM themes JOIN best USING (dt, theme) WHERE item_rank = 1", KEPT))
def batch_lines(spark, sf):
    t = themes(spark, sf)
    return P.batch_summary_lines(t["themes"], t["items"], ["dt"]).select("dt", "batch", "line")


@query("rp09_monthly_report_lines")
def monthly_lines(spark, sf):
    rows, meta, parts = monthly(spark, sf)
    return numbered(P.monthly_report_lines(rows, meta, parts), ["month"])


@query("sk07_period_report_sink", with_items("SELECT strftime(published_at + to_months(CAST(day(published_at) AS INT)), '%Y-%m') AS month, count(*) AS total_items, 2 AS schema_version, '# ' || month AS markdown FROM items GROUP BY 1"))
def period_meta(spark, sf):
    from briefwright.session import shared_folder
    from briefwright.sources.sinks import write_period_report

    _, meta, _ = monthly(spark, sf)
    folder = shared_folder(spark)
    write_period_report(meta, meta.select("month", F.concat(F.lit("# "), "month").alias("markdown")), folder)
    read = spark.read.schema(meta.schema).parquet(f"{folder}/meta")
    report = spark.read.schema("markdown string, month string").parquet(f"{folder}/text")
    return read.join(report, "month").select("month", "total_items", "schema_version", "markdown")


@query("rp10_higher_period_lines")
def higher(spark, sf):
    _, meta, _ = monthly(spark, sf)
    keyed = meta.withColumn("period_key", F.concat(F.substring("month", 1, 4), F.lit("-Q"), F.quarter(F.to_date(F.concat("month", F.lit("-01")))).cast("string")))
    return numbered(P.higher_period_lines(P.compact_months(keyed), "quarterly"), ["period_key"])


def reports(spark, sf):
    """Daily reports written from the documents: sections, bullets with links, follow-up lines."""
    d = table(spark, sf, "documents")
    text = F.coalesce("text", F.lit(""))
    n = F.col("doc_id").cast("string")
    line = F.concat_ws("\n", F.lit("# Digest\n## 1. Today's Top Headlines\n\n> note"),
                       F.concat(F.lit("- **["), text, F.lit("](https://a.example/"), (F.col("doc_id") % 300).cast("string"), F.lit(")** （来源）")),
                       F.lit("  - 摘要：short words here"), F.concat(F.lit("2. Second "), "source", F.lit(" item")), F.concat(F.lit("  - 原文：https://b.example/"), n, F.lit("。")),
                       F.lit("  - 提示：later hint"), F.lit("### Platform Statistics"), F.concat(F.lit("- stats https://c.example/"), n), F.lit("| table |"), F.lit("## 2. More"), F.lit("- no link here"), F.lit("- 原文：https://d.example/1"))
    return d.select(F.concat(F.lit("digest-2026-01-01-"), F.lpad(n, 8, "0"), F.lit(".md")).alias("report_id"), F.translate(line, "[]", "[]").alias("markdown"), "doc_id", "text", "source")


URLS = r"https?://[^\s\x{3000})）\]】,，;；]+"
CASES = rf"""md AS (SELECT 'digest-2026-01-01-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.md' AS report_id, concat_ws(chr(10), '# Digest', '## 1. Today''s Top Headlines', '', '> note',
      '- **[' || coalesce(text, '') || '](https://a.example/' || (doc_id % 300) || ')** （来源）', '  - 摘要：short words here', '2. Second ' || source || ' item', '  - 原文：https://b.example/' || doc_id || '。',
      '  - 提示：later hint', '### Platform Statistics', '- stats https://c.example/' || doc_id, '| table |', '## 2. More', '- no link here', '- 原文：https://d.example/1') AS md FROM documents),
    split AS (SELECT report_id, regexp_split_to_array(md, '\r\n|[\n\x0B\f\r\x{{85}}\x{{2028}}\x{{2029}}]') AS l FROM md),
    raw AS (SELECT report_id, unnest(l) AS raw, unnest(range(len(l))) AS ord FROM split),
    bare AS (SELECT *, rtrim(raw, ' ') AS line, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS bare FROM raw),
    kinds AS (SELECT *, starts_with(bare, '## ') OR starts_with(bare, '### ') AS is_section, regexp_matches(line, '^\s*(?:- |\d+\.\s+)') AND NOT regexp_matches(line, '^\s{{2,}}-\s+') AS is_top FROM bare WHERE bare <> ''),
    parts AS (SELECT *, coalesce(last_value(CASE WHEN is_section THEN regexp_replace(regexp_replace(bare, '^#{{2,3}} ', ''), '^\s+|\s+$', '', 'g') END IGNORE NULLS) OVER w, '') AS section,
      sum(CASE WHEN is_section OR is_top THEN 1 ELSE 0 END) OVER w AS part,
      coalesce(list_filter(list_transform(regexp_extract_all(bare, '{URLS}'), lambda u: rtrim(u, '),.，。;；]）')), lambda u: u <> '')[1], '') AS link FROM kinds WINDOW w AS (PARTITION BY report_id ORDER BY ord)),
    marked AS (SELECT *, NOT is_top AND link <> '' AND regexp_matches(bare, '原文|链接|作者|详见|详情') AS is_link, NOT is_top AND regexp_matches(bare, '摘要：|提示：|总结|简述') AS is_snippet
      FROM parts WHERE NOT is_section AND NOT starts_with(bare, '|')),
    grouped AS (SELECT report_id, section, part, min(ord) FILTER (is_top) AS pos, max(bare) FILTER (is_top) AS head, max(link) FILTER (is_top) AS own, arg_min(link, ord) FILTER (is_link) AS later,
      min(ord) FILTER (is_link) AS later_ord, list({{'o': ord, 't': regexp_replace(bare, '^[-*]\s*', '')}} ORDER BY ord) FILTER (is_snippet) AS snippets FROM marked GROUP BY ALL),
    t1 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(head, '^[-*]\s+', ''), '^\d+\.\s*', ''), '\[([^\]]+)\]\((https?://[^)]+)\)', '\1', 'g'), 'https?://\S+', '', 'g') AS t FROM grouped WHERE pos IS NOT NULL),
    t2 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(replace(replace(t, '**', ''), '`', ''), '^高亮[:：]?\s*', ''), '(原文|链接|讨论|详情|技术报告|Link|更多信息)[:：].*$', '', 'i'), '(—\s*Link|。链接|链接)$', '', 'i') AS u FROM t1),
    t3 AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(u, '（[^（）]{{1,20}}）$', ''), '\([^()]{{1,20}}\)$', ''), '\s+', ' ', 'g'), ' -：:;；，。,') AS title,
      CASE WHEN own <> '' THEN own ELSE coalesce(later, '') END AS url FROM t2),
    cases AS (SELECT report_id, CAST(pos AS INT) AS pos, title, url, section, coalesce(list_filter(snippets, lambda s: own <> '' OR later_ord IS NULL OR s.o <> later_ord)[1].t, '') AS snippet FROM t3
      WHERE title <> '' AND url <> '' AND NOT starts_with(lower(section), 'platform statistics') AND NOT regexp_matches(title, '^(?:原文：|链接：|链接/作者：|作者/链接：|提示：|摘要：)'))"""


@query("st34_case_extraction", f"WITH {CASES} SELECT report_id, title, url, section, snippet FROM cases")
def cases(spark, sf):
    return M.extract_cases(reports(spark, sf)).select("report_id", "title", "url", "section", "snippet")


@query("st34_case_extraction_whole", f"WITH {CASES} SELECT report_id, pos, title, url, section, snippet FROM cases")
def whole_cases(spark, sf):
    return M.extract_cases(reports(spark, sf)).select("report_id", "pos", "title", "url", "section", "snippet")


STOP = _list(sorted({t.lower() for t in L["report_stop"]}))
WORDS = "list_filter(regexp_extract_all({0}, '([A-Za-z][A-Za-z0-9.+-]{{2,}}|[一-鿿]{{2,}})', 1), lambda w: NOT list_contains(" + STOP.replace("{", "{{").replace("}", "}}") + ", lower(w)))"
COUNTS = f"""{CASES}, spoken AS (SELECT report_id, pos, unnest(w) AS word, unnest(range(len(w))) AS place FROM (SELECT report_id, pos, {WORDS.format("concat_ws(' ', title, snippet, section)")} AS w FROM cases)),
    counts AS (SELECT word, count(*) AS n, min({{'r': report_id, 'p': pos, 'a': place}}) AS first_seen FROM spoken GROUP BY word)"""


@query("ag22_period_keywords", f"WITH {COUNTS} SELECT word, n FROM counts ORDER BY n DESC, first_seen LIMIT 8")
def period_keywords(spark, sf):
    return A.report_keyword_counts(M.extract_cases(reports(spark, sf)), L).orderBy(F.col("n").desc(), "first_seen").limit(8).select("word", "n")


@query("wn13_case_score", f"""WITH {COUNTS}, one AS (SELECT * FROM cases QUALIFY row_number() OVER (PARTITION BY url ORDER BY report_id, pos) = 1),
    totals AS (SELECT url, sum(n) AS total FROM (SELECT url, unnest({WORDS.format("concat_ws(' ', title, snippet)")}) AS word FROM one) JOIN counts USING (word) GROUP BY url)
    SELECT report_id, title, CAST(coalesce(total, 0) + CASE WHEN starts_with(section, '1.') THEN 2 ELSE 0 END AS BIGINT) AS case_score FROM one LEFT JOIN totals USING (url)""")
def case_score(spark, sf):
    found = cut_lineage(M.extract_cases(reports(spark, sf)))
    return A.score_cases(found, A.report_keyword_counts(found, L), L).select("report_id", "title", "case_score")


@query("rp11_periodic_report_lines")
def periodic(spark, sf):
    r = reports(spark, sf).select("report_id", "markdown")
    return numbered(P.case_report_lines(r, "2026-01-01", "2026-01-31", "2026-01", "monthly", L), ["period_key"])


@query("st33_markdown_section_bullets", "SELECT doc_id, source AS a, lang || '|x' AS b, CAST(n_chars AS VARCHAR) AS c FROM documents")
def sections(spark, sf):
    d = table(spark, sf, "documents").withColumn("md", F.concat(F.lit("# t\n## 核心观察\nintro\n- "), "source", F.lit("\n- two\n## 主题聚焦\n### 本批核心主题\n- "), "lang", F.lit("\n  - x\n### z\n"), F.col("n_chars").cast("string"), F.lit("\n## e")))
    c = F.col("md")
    return d.select("doc_id", F.element_at(M.section_bullets(c, "核心观察", 1), 1).alias("a"), F.array_join(M.section_bullets(c, "本批核心主题", None, 3), "|").alias("b"), F.btrim(M.section_body(c, "z", 3), F.lit("\n# e")).alias("c"))
