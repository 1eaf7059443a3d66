"""Report text queries."""

from pyspark.sql import functions as F

from briefwright.functions import markdown as M, text as T
from briefwright.operators import usage as G
from briefwright.plans import calendar as C, ledger as D, reports as P
from catalog.aggregates import USAGE, _entries
from catalog.base import items, query, table, with_items
from catalog.filters import url_status
from catalog.windows import calendar as calendar_rows, ledger_rows


def texts(spark, sf):
    d = table(spark, sf, "documents")
    n = F.col("doc_id") % 6
    mark = F.when(n == 0, "**open").when(n == 1, " ```code").when(n == 2, " (").when(n == 3, " ok.").when(n == 4, " `x").otherwise("")
    return d.select("doc_id", F.concat(F.regexp_replace("text", "[*`]", " "), mark).alias("md"))


@query("st39_report_quality_flags", r"""SELECT doc_id, md = '' OR odd OR regexp_matches(rt, '[\[({"“—:]$') OR (ends_with(rt, '*') AND NOT ends_with(rt, '**')) OR (ends_with(rt, '`') AND NOT ends_with(rt, '```')) AS truncated,
    length(md) <= 500 AND contains(lower(md), 'as an ai') AS refusal FROM (SELECT doc_id, md, regexp_replace(md, '\s+$', '') AS rt, doc_id % 6 IN (0, 1) AS odd FROM (SELECT doc_id, regexp_replace(text, '[*`]', ' ', 'g') ||
    CASE doc_id % 6 WHEN 0 THEN '**open' WHEN 1 THEN ' ```code' WHEN 2 THEN ' (' WHEN 3 THEN ' ok.' WHEN 4 THEN ' `x' ELSE '' END AS md FROM documents))""")
def quality(spark, sf):
    return texts(spark, sf).select("doc_id", M.is_truncated(F.col("md")).alias("truncated"), M.is_refusal(F.col("md")).alias("refusal"))


@query("st39_digest_fault", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'too_short_for_digest' WHEN doc_id % 3 = 0 THEN 'missing_theme_section' WHEN doc_id % 5 = 0 THEN 'too_few_top_headlines:1' WHEN doc_id % 7 = 0 THEN 'top_headlines_missing_links' END AS fault FROM documents""")
def fault(spark, sf):
    k = F.col("doc_id")
    heads = F.when(k % 5 == 0, "- one http").when(k % 7 == 0, F.repeat(F.lit("- one\n"), 8)).otherwise(F.repeat(F.lit("- one http\n"), 8))
    body = F.concat(F.lit("## 1. Today's Top 10\n"), heads, F.when(k % 3 == 0, "\n## 2. other\n").otherwise("\n## 2. 主题与分类精选\n"), F.repeat(F.lit("word "), 200), F.lit("end."))
    return table(spark, sf, "documents").select("doc_id", M.digest_fault(F.when(k % 2 == 0, "tiny.").otherwise(body)).alias("fault"))


def pages_md(spark, sf):
    p = table(spark, sf, "pages")
    return p.select(F.col("page_id").alias("report_id"), F.concat(F.lit("see [a [b] c](<"), "url", F.lit(">) and https://bare.example/"), F.col("page_id").cast("string"), F.lit(".")).alias("markdown"), "url", "page_id")


@query("st37_normalise_markdown_links", """SELECT page_id AS report_id, CASE WHEN s BETWEEN 200 AND 399 OR s IN (401, 403, 429) THEN 'see [a b c](' || url || ')' ELSE 'see a b c' END || ' and link.' AS markdown
    FROM (SELECT page_id, url, [200, 301, 404, 403, 500, 429, 204, 401, 410][page_id % 9 + 1] AS s FROM pages)""")
def links(spark, sf):
    from briefwright.functions.urls import heat_is_open

    status = url_status(spark, sf).select("url", heat_is_open(F.col("status")).alias("is_open"))
    return M.sanitise_links(pages_md(spark, sf), status)


@query("st38_report_structure_cleanup", "SELECT doc_id AS report_id, '# Digest' || chr(10) || '## 平台统计' || chr(10) || '- ' || source || chr(10) || '## 2. 主题与分类精选' || chr(10) || '### 分类补充' || chr(10) || 'end' || chr(10) AS markdown FROM documents")
def structure(spark, sf):
    d = table(spark, sf, "documents")
    md = F.concat(F.lit("# Digest\n## 平台统计\n- "), "source", F.lit("\n## 重要候选信息\n- gone\n### also\ngone\n## 3. 跨平台主题分析\n## 分类详情\n## 平台统计\n- twice\n### sub\nx\n## Platform Statistics\n- en\n"))
    md = F.concat(F.regexp_replace(md, "## 分类详情\n", "## 分类详情\nend\n"), F.lit(""))
    return M.clean_structure(d.select(F.col("doc_id").alias("report_id"), md.alias("markdown")))


@query("rp12_short_message")
def short_message(spark, sf):
    d = table(spark, sf, "documents")
    md = F.concat(F.lit("# Digest\n## 平台统计\n- "), "source", F.lit("\n---\n## 1. Today's Top 10 Headlines\n- [x](https://a.example/"), F.col("doc_id").cast("string"), F.lit(")\n## 2. 主题\n### sub\n"), "text")
    rows = d.select(F.col("doc_id").alias("report_id"), md.alias("markdown"), F.lit("2026-01-01").alias("date"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("generated_at"), F.lit(10).alias("items_count"), F.lit(2).alias("sources_count"))
    out = P.short_message(rows, "Token 使用与费用：无", "https://feed.example/")
    return out.select("report_id", F.length("message").alias("n"), F.md5("message").alias("h"))


@query("rp13_insert_section", """SELECT doc_id AS report_id, CASE WHEN doc_id % 3 = 0 THEN '# t' || chr(10) || 'S' || chr(10) || '## 3. 主题与分类精选 x' || chr(10) || source || chr(10) WHEN doc_id % 3 = 1 THEN '# t' || chr(10) || source || chr(10) || chr(10) || 'S' || chr(10)
    ELSE '最近要发生的重要产业事件' || chr(10) END AS markdown FROM documents""")
def insert(spark, sf):
    k = F.col("doc_id") % 3
    md = F.when(k == 0, F.concat(F.lit("# t\n## 2. 主题与分类精选 x\n"), "source")).when(k == 1, F.concat(F.lit("# t\n"), "source")).otherwise("最近要发生的重要产业事件")
    return P.insert_section(table(spark, sf, "documents").select(F.col("doc_id").alias("report_id"), md.alias("markdown")), F.lit("S\n"))


@query("rp06_chunk_lines")
def chunk_lines(spark, sf):
    rows = ledger_rows(spark, sf).withColumns({"ord": F.col("event_rank"), "chunk": F.expr("event_rank div 100")})
    return P.numbered(P.chunk_lines(rows, ["chunk"]), ["chunk"])


@query("rp07_coverage_supplement")
def supplement(spark, sf):
    from briefwright.operators.joins import missing_coverage

    d = table(spark, sf, "documents")
    reports = d.select(F.col("doc_id").alias("report_id"), F.col("text").alias("markdown"))
    rows = d.select((F.col("doc_id") - F.col("doc_id") % 2).alias("report_id"), (F.col("doc_id") % 7 + 1).alias("priority"), F.lit(1).alias("category_rank"), F.col("source").alias("category"),
                    F.lit("").alias("event_id"), F.substring("text", 1, 60).alias("title"), F.lit("").alias("url"), "source", F.substring("text", 1, 220).alias("reason"))
    return P.numbered(P.supplement_lines(missing_coverage(reports, rows, 4), reports), ["report_id"])


@query("rp08_raw_listing_lines")
def raw_listing(spark, sf):
    rows = ledger_rows(spark, sf).withColumn("ord", F.col("event_rank"))
    return P.numbered(P.raw_listing_lines(rows, ["_run"]), ["_run"])


@query("ag16_statistics_lines", with_items("SELECT 2 AS ord, '- 总计：' || count(*) || ' 条，来自 ' || count(DISTINCT source) || ' 个信息源。' AS line FROM items"))
def statistics(spark, sf):
    i = items(spark, sf)
    return P.statistics_lines(i, i.select(F.col("language").alias("category"))).where("ord = 2")


@query("st44_usage_format", f"WITH {USAGE} SELECT 'footer' AS kind, 'Token 使用与费用：输入 ' || printf('%,d', CAST(sum(i) AS BIGINT)) AS line FROM e UNION ALL SELECT 'section', '- 输出 tokens：' || printf('%,d', CAST(sum(o) AS BIGINT)) FROM e")
def usage_format(spark, sf):
    rolled = G.usage_rollup(_entries(spark, sf))
    footer = G.usage_footer(rolled).select(F.lit("footer").alias("kind"), F.substring_index("footer", " / 输出", 1).alias("line"))
    return footer.unionByName(G.usage_lines(rolled).where("line like '- 输出 tokens%'").select(F.lit("section").alias("kind"), "line"))


@query("st46_category_section", with_items("SELECT source AS category, 3 * rn + 1 AS a, '  > ' || replace(substr(content, 1, 200), chr(10), ' ') || CASE WHEN length(content) > 200 THEN '...' ELSE '' END AS line FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, pos) AS rn FROM items) WHERE rn <= 20 AND content <> ''"))
def category_section(spark, sf):
    from briefwright.operators.ranking import by_score, ranked

    rows = ranked(items(spark, sf).withColumn("category", F.col("source")), by_score(), ["category"], "category_rank")
    return P.category_section(rows).where("line like '  > %'")


@query("ca04_calendar_lines")
def calendar_lines(spark, sf):
    p = table(spark, sf, "part")
    events = p.select(F.col("p_name").alias("title"), F.col("p_brand").alias("organizer"), F.col("p_type").alias("location"), F.concat(F.lit("https://e.example/"), F.col("p_partkey").cast("string")).alias("url"), F.lit("").alias("note"), F.lit(None).cast("string").alias("date_label"),
                      F.date_add(F.lit("2026-03-01").cast("date"), (F.col("p_partkey") % 120).cast("int")).cast("string").alias("start_date"), F.lit(None).cast("string").alias("end_date"),
                      (F.col("p_partkey") % 60).cast("int").alias("priority"), F.array(F.lit("x")).alias("focus"), (F.col("p_partkey") % 11 == 0).alias("always_show"), F.lit(True).alias("enabled"))
    return P.calendar_lines(C.event_window(events, F.lit("2026-04-01").cast("date")))


@query("ag25_health_section")
def health(spark, sf):
    h = items(spark, sf).select("source", (F.col("pos") % 3 != 0).alias("success"), F.when(F.col("pos") % 5 == 0, "recovered").alias("repair_status"), F.array(F.lit("retry"), F.lit("login")).alias("repair_actions"),
                                F.array(F.lit("slow")).alias("repair_notes"), F.substring("content", 1, 40).alias("error"))
    return P.health_section(h)


@query("sk06_eval_sinks", with_items("""SELECT dt, count(*) AS raw_items, count(*) FILTER (WHERE item_id % 3 = 0) AS labels FROM items GROUP BY dt"""))
def eval_rows(spark, sf):
    from briefwright.session import shared_folder
    from briefwright.sources.sinks import write_evaluation

    folder, rows = shared_folder(spark), items(spark, sf)
    metrics = rows.groupBy("dt").agg(F.count(F.lit(1)).alias("raw_items"))
    labels = rows.groupBy("dt").agg(F.count_if(F.col("item_id") % 3 == 0).alias("labels"))
    write_evaluation(metrics, labels, folder)
    write_evaluation(metrics, labels, folder)  # days that are written again replace themselves
    read = lambda name, kind: spark.read.schema(f"{kind} long, dt string").parquet(f"{folder}/{name}")
    return read("metrics", "raw_items").join(read("labels", "labels"), "dt").select("dt", "raw_items", "labels")
