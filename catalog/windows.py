"""Ranking, set and calendar queries."""

from pyspark.sql import Window, functions as F

from briefwright.functions import text as T
from briefwright.lexicon import Lexicon
from briefwright.operators import ranking as K, relevance as V
from briefwright.plans import calendar as C, ledger as D
from briefwright.sources.plugin import union_sources
from catalog.base import ITEMS, host, items, query, table, with_items
from catalog.filters import RELEVANT, RUNS, runs
from catalog.joins import REG, tier_sql, weight_sql
from catalog.scoring import VOTES, topic_sql

L = Lexicon()


@query("wn01_top_n_per_source", with_items("SELECT source, item_id FROM items QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, pos) <= 7"))
def top_n(spark, sf):
    return K.top_n_per_source(items(spark, sf), 7).select("source", "item_id")


NORM = r"lower(trim(regexp_replace(regexp_replace(substr(trim(regexp_replace(title, '\s+', ' ', 'g')), 1, 200), 'https?://\S+', '', 'g'), '[`*_>#]', '', 'g')))"


@query("wn02_first_by_normalised_title", with_items(f"""SELECT item_id, norm FROM (SELECT item_id, pos, score, title, {NORM} AS norm FROM items) WHERE norm <> ''
    QUALIFY row_number() OVER (PARTITION BY norm ORDER BY score DESC, length(title), pos) = 1 ORDER BY score DESC, length(title), pos LIMIT 180"""))
def first_titles(spark, sf):
    from briefwright.operators.themes import representative_items

    rows = representative_items(items(spark, sf), 180)
    return rows.select("item_id", T.normalise_title(F.col("title")).alias("norm"))


MAIN = f"(CASE {tier_sql('source', 'url')} WHEN 'T1' THEN 4 WHEN 'T1.5' THEN 3 WHEN 'T2' THEN 2 ELSE 1 END)"


@query("wn03_main_item", with_items(f"""SELECT dt, item_id FROM items QUALIFY row_number() OVER (PARTITION BY dt ORDER BY {MAIN} DESC, {weight_sql('source', 'url')} DESC,
    CASE WHEN lower(regexp_extract(url, '//([^/?#]*)', 1)) IN ('x.com', 'twitter.com', 'reddit.com', 'youtube.com', 'youtu.be') THEN 1 ELSE 0 END, score - least(length(title), 240) * 0.001::DOUBLE DESC, title DESC, pos) = 1"""))
def main_item(spark, sf):
    from briefwright.operators.scoring import main_order

    rows = items(spark, sf).withColumns({"tier": REG.tier(F.col("source"), F.col("url")), "source_weight": REG.weight(F.col("source"), F.col("url")), "rank": F.col("pos")})
    best = rows.groupBy("dt").agg(F.max_by("item_id", F.struct(*main_order())).alias("item_id"))
    return best


@query("wn04_event_rank", with_items("SELECT dt, item_id, row_number() OVER (PARTITION BY dt ORDER BY score DESC, length(title) DESC, pos) AS event_rank FROM items"))
def event_rank(spark, sf):
    return K.ranked(items(spark, sf), [F.col("score").desc(), F.length("title").desc(), F.col("pos")], ["dt"], "event_rank").select("dt", "item_id", "event_rank")


@query("wn05_selection_rank", with_items("SELECT dt, item_id, CASE WHEN score >= 100 THEN row_number() OVER (PARTITION BY dt, score >= 100 ORDER BY score DESC, pos) END AS selection_rank FROM items"))
def selection_rank(spark, sf):
    i = items(spark, sf)
    chosen = K.ranked(i.where("score >= 100"), K.by_score(), ["dt"], "selection_rank").select("item_id", "selection_rank")
    return i.join(chosen, "item_id", "left").select("dt", "item_id", "selection_rank")


LROWS = """lrows AS (SELECT '' AS run, source AS category, 'e' || item_id AS event_id, title, url, source, score, CAST(length(source) AS DOUBLE) AS w, item_id % 9 = 0 AS selected,
    CASE WHEN item_id % 9 = 0 THEN item_id END AS selection_rank, pos FROM items)"""


def ledger_rows(spark, sf):
    return items(spark, sf).select(
        F.lit("").alias("_run"), F.col("source").alias("category"), F.concat(F.lit("e"), F.col("item_id") % 500).alias("event_id"), F.col("title").alias("event_title"), "url", "source", "score",
        F.length("source").cast("double").alias("source_weight"), (F.col("item_id") % 9 == 0).alias("selected"), F.when(F.col("item_id") % 9 == 0, F.col("item_id")).alias("selection_rank"),
        F.col("pos").alias("event_rank"), F.substring("content", 1, 220).alias("reason"))


@query("wn06_category_priority", with_items("SELECT category, event_rank, category_rank FROM (SELECT category, pos AS event_rank, row_number() OVER (PARTITION BY category ORDER BY selected DESC, CASE WHEN selected THEN selection_rank ELSE 0 END, score DESC, w DESC, title DESC, pos) AS category_rank FROM lrows) WHERE category_rank <= 8", LROWS))
def category_priority(spark, sf):
    return D.category_priorities(ledger_rows(spark, sf)).select("category", "event_rank", "category_rank")


@query("wn07_importance_ledger", with_items("""SELECT priority, event_rank, priority <= 35 AS must_cover FROM (SELECT row_number() OVER (ORDER BY score DESC, w DESC, title DESC, pos) AS priority, pos AS event_rank FROM
    (SELECT * FROM lrows QUALIFY row_number() OVER (PARTITION BY pos % 500 ORDER BY score DESC, w DESC, title DESC, pos) = 1)) WHERE priority <= 80""", LROWS))
def importance(spark, sf):
    return D.importance_ledger(ledger_rows(spark, sf), 10).select("priority", "event_rank", "must_cover")


@query("wn08_per_source_cap", with_items("SELECT dt, source, item_id FROM items QUALIFY row_number() OVER (PARTITION BY dt, source ORDER BY pos) <= 2"))
def source_cap(spark, sf):
    return K.top_k(items(spark, sf), ["dt", "source"], [F.col("pos")], 2).select("dt", "source", "item_id")


@query("wn14_latest_run", f"WITH {RUNS} SELECT date, phase, max(started_at) AS started_at FROM runs GROUP BY date, phase")
def latest_run(spark, sf):
    return K.latest_per(runs(spark, sf), ["date", "phase"], "started_at").select("date", "phase", "started_at")


@query("wn16_topic_extras", with_items("SELECT source AS category, item_id FROM items WHERE score < 100 QUALIFY row_number() OVER (PARTITION BY source ORDER BY pos) <= 3"))
def extras(spark, sf):
    from briefwright.plans.reports import topic_extras

    rows = items(spark, sf).where("score < 100").select(F.lit("").alias("_run"), F.col("source").alias("category"), F.col("pos").alias("event_rank"), "item_id")
    return topic_extras(rows).select("category", "item_id")


@query("wn17_chunk_top_rows", with_items("""SELECT dt, 'best' AS kind, pos AS event_rank FROM (SELECT dt, pos, score, source, title FROM items QUALIFY row_number() OVER (PARTITION BY dt ORDER BY score DESC, length(source) DESC, pos) <= 12)
    UNION ALL SELECT dt, 'category', pos FROM (SELECT dt, pos FROM items QUALIFY row_number() OVER (PARTITION BY dt, source ORDER BY item_id % 9 = 0 DESC, CASE WHEN item_id % 9 = 0 THEN item_id ELSE 0 END, score DESC, length(source) DESC, title DESC, pos) <= 3)"""))
def chunk_top(spark, sf):
    rows = ledger_rows(spark, sf).join(items(spark, sf).select(F.col("pos").alias("event_rank"), "dt"), "event_rank").withColumn("ord", F.col("event_rank"))
    return D.chunk_rows(rows, ["dt"]).select("dt", "kind", "event_rank")


@query("wn18_sort_by_score", with_items("SELECT item_id, score FROM items ORDER BY score, pos"))
def sort_score(spark, sf):
    return K.sort_by_score(items(spark, sf), False).select("item_id", "score")


@query("wn19_top_k_cuts", with_items("SELECT item_id FROM items ORDER BY score DESC, pos LIMIT 300"))
def top_k(spark, sf):
    return K.top_scored(items(spark, sf), 300).select("item_id")


@query("se01_union_sources", "SELECT source, count(*) AS n FROM (SELECT source FROM documents UNION ALL SELECT 'page' FROM pages UNION ALL SELECT role FROM conversations) GROUP BY source")
def union(spark, sf):
    parts = [table(spark, sf, "documents").select("source", "lang"), table(spark, sf, "pages").select(F.lit("page").alias("source"), "url"), table(spark, sf, "conversations").select(F.col("role").alias("source"), "turn")]
    return union_sources(parts).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("se02_ordered_distinct", with_items("SELECT trim(author) AS author, min(pos) AS first_pos FROM items WHERE trim(author) <> '' GROUP BY trim(author)"))
def ordered_distinct(spark, sf):
    return K.ordered_distinct(items(spark, sf), "author")


@query("se03_distinct_in_source", with_items("SELECT source, item_id FROM items WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY source, rtrim(url, '/') ORDER BY pos) = 1"))
def distinct_in_source(spark, sf):
    from briefwright.functions.urls import normalise_url

    rows = items(spark, sf).where("url <> ''").withColumn("u", normalise_url(F.col("url")))
    return K.first_per(rows, ["source", "u"], [F.col("pos")]).select("source", "item_id")


@query("se04_row_exclusion", with_items("SELECT item_id FROM items WHERE item_id NOT IN (SELECT doc_id FROM labels)"))
def exclusion(spark, sf):
    return items(spark, sf).join(table(spark, sf, "labels").select(F.col("doc_id").alias("item_id")), "item_id", "left_anti").select("item_id")


@query("ag18_group_by_category", with_items("""SELECT topic AS category, item_id, row_number() OVER (PARTITION BY topic ORDER BY score DESC, pos) AS category_rank
    FROM (SELECT item_id, score, pos, topic FROM topics)""", RELEVANT, VOTES, topic_sql()))
def group_by_category(spark, sf):
    return V.group_by_category(items(spark, sf), L).select("category", "category_rank", "item_id")


DAY = "CAST(o_orderdate AS DATE)"


def bounds_sql(period):
    unit = {"weekly": "week", "monthly": "month", "quarterly": "quarter", "annual": "year"}.get(period)
    if period == "semiannual":
        start = f"(CASE WHEN month({DAY}) <= 6 THEN make_date(year({DAY}), 1, 1) ELSE make_date(year({DAY}), 7, 1) END)"
        key = f"year({DAY}) || CASE WHEN month({DAY}) <= 6 THEN '-H1' ELSE '-H2' END"
        step = "INTERVAL 6 MONTH"
    else:
        start = f"CAST(date_trunc('{unit}', {DAY}) AS DATE)"
        step = {"weekly": "INTERVAL 7 DAY", "monthly": "INTERVAL 1 MONTH", "quarterly": "INTERVAL 3 MONTH", "annual": "INTERVAL 12 MONTH"}[period]
        key = {"weekly": f"printf('%04d-W%02d', isoyear({DAY}), week({DAY}))", "monthly": f"strftime({DAY}, '%Y-%m')", "quarterly": f"year({DAY}) || '-Q' || quarter({DAY})", "annual": f"CAST(year({DAY}) AS VARCHAR)"}[period]
    return f"SELECT DISTINCT '{period}' AS period, strftime({DAY}, '%Y-%m-%d') AS day, strftime({start}, '%Y-%m-%d') AS p_start, strftime(CAST({start} + {step} - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS p_end, {key} AS p_key FROM orders"


@query("ca01_period_bounds", " UNION ALL ".join(bounds_sql(p) for p in C.PERIODS))
def period_bounds(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    rows = F.array(*[F.struct(F.lit(p).alias("period"), C.period_bounds(F.col("d"), p).alias("b")) for p in C.PERIODS])
    return days.select(F.col("d").cast("string").alias("day"), F.explode(rows).alias("r")).select(
        "day", "r.period", F.col("r.b.start").cast("string").alias("p_start"), F.col("r.b.end").cast("string").alias("p_end"), F.col("r.b.key").alias("p_key"))


@query("ca01_completed_period", f"""SELECT DISTINCT strftime({DAY}, '%Y-%m-%d') AS day, strftime(date_trunc('quarter', {DAY}) - INTERVAL 1 DAY, '%Y') || '-Q' || quarter(CAST(date_trunc('quarter', {DAY}) - INTERVAL 1 DAY AS DATE)) AS q,
    CASE WHEN month({DAY}) <= 6 THEN (year({DAY}) - 1) || '-H2' ELSE year({DAY}) || '-H1' END AS h, CAST(year({DAY}) - 1 AS VARCHAR) AS y FROM orders""")
def completed(spark, sf):
    d = F.col("d")
    return table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct().select(
        d.cast("string").alias("day"), C.period_bounds(d, "quarterly", True)["key"].alias("q"), C.period_bounds(d, "semiannual", True)["key"].alias("h"), C.period_bounds(d, "annual", True)["key"].alias("y"))


@query("ca02_month_arithmetic", f"""SELECT o_orderkey, strftime({DAY}, '%Y-%m') AS month, strftime(date_trunc('month', {DAY}) + to_months(CAST(o_orderkey % 25 - 12 AS INT)), '%Y-%m-%d') AS shifted,
    array_to_string(list_transform(generate_series(date_trunc('month', {DAY}), date_trunc('month', {DAY}) + INTERVAL 2 MONTH, INTERVAL 1 MONTH), lambda m: strftime(m, '%Y-%m')), ',') AS months FROM orders""")
def months(spark, sf):
    d = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", C.month_key(d).alias("month"), C.shift_month(d, (F.col("o_orderkey") % 25 - 12).cast("int")).cast("string").alias("shifted"),
                                             F.array_join(C.months_between(d, F.add_months(F.trunc(d, "month"), 2)), ",").alias("months"))


@query("ca03_day_boundary_tz", "SELECT event_id, CAST(ts - INTERVAL 8 HOUR AS DATE) + INTERVAL 8 HOUR AS day_start, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS shown FROM events")
def day_boundary(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select("event_id", C.local_day_bounds(ts, "America/Los_Angeles")["start"].alias("day_start"), C.report_time(ts).alias("shown"))


CAL = """cal AS (SELECT p_partkey, p_name AS title, strftime(DATE '2026-03-01' + CAST(p_partkey % 120 AS INT), '%Y-%m-%d') AS start_date, CAST(p_partkey % 60 AS INT) AS priority, p_partkey % 11 = 0 AS always, p_partkey % 13 = 0 AS undated FROM part),
  days AS (SELECT *, CASE WHEN undated THEN NULL ELSE CAST(start_date AS DATE) END AS d, CASE WHEN priority = 0 THEN 50 ELSE priority END AS pr FROM cal),
  buckets AS (SELECT *, CASE WHEN d IS NULL THEN CASE WHEN always THEN 'undated' END WHEN d < DATE '2026-04-01' THEN CASE WHEN d >= DATE '2026-03-02' AND always THEN 'recent' END
    WHEN d <= DATE '2026-05-01' AND (d - DATE '2026-04-01' <= 7 OR always) THEN 'upcoming' END AS bucket FROM days)"""


@query("ca04_event_calendar_window", f"""WITH {CAL} SELECT p_partkey, bucket, slot FROM (SELECT p_partkey, bucket, row_number() OVER (PARTITION BY bucket ORDER BY CASE WHEN bucket = 'recent' THEN -(d - DATE '2000-01-01') ELSE coalesce(d - DATE '2000-01-01', 0) END,
    CASE WHEN bucket = 'recent' THEN -pr ELSE pr END, CASE WHEN bucket <> 'recent' THEN title END, CASE WHEN bucket = 'recent' THEN title END DESC, p_partkey) AS slot FROM buckets WHERE bucket IS NOT NULL)
    WHERE slot <= CASE bucket WHEN 'upcoming' THEN 8 WHEN 'recent' THEN 4 ELSE 5 END""")
def calendar(spark, sf):
    p = table(spark, sf, "part")
    events = p.select("p_partkey", F.col("p_name").alias("title"), F.lit("org").alias("organizer"), F.lit("").alias("location"), F.lit("").alias("url"), F.lit("").alias("note"), F.lit(None).cast("string").alias("date_label"),
                      F.when(F.col("p_partkey") % 13 != 0, F.date_add(F.lit("2026-03-01").cast("date"), (F.col("p_partkey") % 120).cast("int")).cast("string")).alias("start_date"), F.lit(None).cast("string").alias("end_date"),
                      (F.col("p_partkey") % 60).cast("int").alias("priority"), F.array(F.lit("x")).alias("focus"), (F.col("p_partkey") % 11 == 0).alias("always_show"), F.lit(True).alias("enabled"))
    return C.event_window(events, F.lit("2026-04-01").cast("date")).select("p_partkey", "bucket", "slot")


@query("rp04_batch_cut", with_items("SELECT item_id, CAST((row_number() OVER (ORDER BY score DESC, pos) - 1) // 25 + 1 AS INT) AS batch FROM items"))
def batch_cut(spark, sf):
    return K.batches(items(spark, sf), K.by_score(), 25).select("item_id", "batch")


@query("st36_ledger_key", with_items("SELECT item_id, CASE WHEN url <> '' THEN 'url:' || lower(trim(url)) ELSE 'title:' || lower(source) || ':' || trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) END AS ledger_key FROM items"))
def ledger_key(spark, sf):
    from briefwright.operators.joins import ledger_key as key

    return items(spark, sf).select("item_id", key(F.lit(""), F.col("url"), F.col("title"), F.col("source")).alias("ledger_key"))


RP03_SQL = "WITH RECURSIVE " + ITEMS + """, d AS (SELECT row_number() OVER (ORDER BY pos) AS i, source_type AS category, length(content) AS chars, length(source_type) + 5 AS header FROM items),
    r AS (SELECT i, 1 AS chunk, 2 + header + chars AS size, [category] AS cats, chars FROM d WHERE i = 1
      UNION ALL SELECT i, CASE WHEN fits THEN chunk ELSE chunk + 1 END, CASE WHEN fits THEN grown ELSE 2 + header + chars END, CASE WHEN fits THEN list_distinct(cats || [category]) ELSE [category] END, chars
      FROM (SELECT d.i, d.header, d.chars, d.category, r.chunk, r.cats, r.size + 1 + d.chars + CASE WHEN list_contains(r.cats, d.category) THEN 0 ELSE d.header END AS grown,
        r.size + 1 + d.chars + CASE WHEN list_contains(r.cats, d.category) THEN 0 ELSE d.header END <= 20000 AS fits FROM r JOIN d ON d.i = r.i + 1))
    SELECT CAST(chunk AS BIGINT) AS chunk, count(*) AS rows_in, CAST(sum(chars) AS BIGINT) AS chars FROM r GROUP BY chunk"""


@query("rp03_size_bounded_chunks", RP03_SQL)
def chunks(spark, sf):
    """One report of all rows, by the sizes of whole texts."""
    rows = items(spark, sf).select(F.lit("all").alias("_run"), F.col("pos").alias("ord"), F.col("source_type").alias("category"), F.length("content").alias("chars"))
    return D.size_bounded_chunks(rows, 20_000).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows_in"), F.sum("chars").alias("chars"))
