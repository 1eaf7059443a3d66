"""Reports as ordered line tables: (run, part, a, b, line), joined to text at the end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import markdown as M, text as T
from briefwright.lexicon import Lexicon
from briefwright.operators.aggregates import category_signals, health_lines, platform_statistics
from briefwright.operators.ranking import ranked, top_k
from briefwright.plans.calendar import PERIOD_NAMES
from briefwright.plans.ledger import chunk_rows
from briefwright.session import cut_lineage

ORD = ["part", "a", "b"]


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _cat(*parts) -> Column:
    return F.concat(*[_lit(p) for p in parts])


def rows_to_lines(df: DataFrame, run: Sequence[str], part: int, a, b, line: Column) -> DataFrame:
    """Rows to lines at a place of the report; rows whose line is null give none."""
    return df.select(*run, F.lit(part).alias("part"), _lit(a).cast("bigint").alias("a"), _lit(b).cast("bigint").alias("b"),
                     line.alias("line")).where("line is not null")


def fixed_lines(runs: DataFrame, run: Sequence[str], part: int, lines: Sequence[str]) -> DataFrame:
    """The same lines for every run."""
    array = F.array(*[F.lit(x) for x in lines])
    return runs.select(*run).distinct().select(*run, F.lit(part).alias("part"), F.posexplode(array).alias("a", "line")).select(
        *run, "part", F.col("a").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "line")


def union_lines(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


def to_text(lines: DataFrame, run: Sequence[str]) -> DataFrame:
    """Lines of a report in order, as one text that ends with a line break."""
    packed = lines.groupBy(*run).agg(F.sort_array(F.collect_list(F.struct(*ORD, "line"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return packed.select(*run, F.concat(F.regexp_replace(body, r"\s+$", ""), F.lit("\n")).alias("markdown"))


def numbered(lines: DataFrame, run: Sequence[str]) -> DataFrame:
    """(run, ord, line) with a plain line number; a report may have any number of lines. They are written before they are ranked, as
    the ranges of the rank are found from a sample, which would compute them a second time."""
    return ranked(cut_lineage(lines), [*[F.col(c) for c in ORD], F.col("line")], run, "ord").select(*run, "ord", "line")


# Headings and notes of the reports.
HEADLINES = "## 1. Today's Top Headlines"
TOPICS_HEADING = "## 2. 主题与分类精选"
LEDGER_NOTE = "> LLM 摘要不可用，以下根据 event ledger 的确定性排序生成；保留主来源与旁证，不展开原始链接列表。"
SUPPLEMENT_NOTE = "> 下面是未进入前面主体部分、但按来源质量和事件分数仍值得保留的少量信号，供后续延伸阅读。"
RAW_HEAD = "## Summary (Raw Data — LLM Unavailable)"
RAW_NOTE = "> LLM 摘要生成失败，以下为按分类整理的原始采集数据。"
EVENTS_HEADING = "最近要发生的重要产业事件"


def daily_lines(events: DataFrame, members: DataFrame, top_n: int = 10) -> DataFrame:
    """Headlines with up to three supporting links, then up to three other events per topic in the order the
    topics appear. Without a selection the first ``top_n`` events lead.

    What the lines need of the events is written first: each kind of line reads them, and the selection would be made again for each."""
    run = ["_run"]
    main = F.struct(*[F.col(f"main.{c}").alias(c) for c in ("url", "source", "tier")]).alias("main")
    events = cut_lineage(events.select(*run, "event", "event_rank", "event_score", "category", "event_title", "selected", "selection_rank", main))
    chosen = events.groupBy(*run).agg(F.bool_or("selected").alias("has_selection"))
    marked = events.join(chosen, run).withColumns({
        "lead": F.when(F.col("has_selection"), F.col("selected")).otherwise(F.col("event_rank") <= top_n),
        "place": F.coalesce("selection_rank", "event_rank"),
        "link": M.item_link(F.col("event_title"), F.col("main.url"))})
    leads = marked.where("lead")
    meta = F.concat_ws(" / ", F.nullif(F.col("main.source"), F.lit("")), F.nullif(F.col("main.tier"), F.lit("")),
                       F.format_string("score %.1f", "event_score"))
    headline = rows_to_lines(leads, run, 1, F.col("place"), 0, _cat(F.col("place").cast("string"), ". **", F.col("link"), "**｜", meta))
    support = members.where("member_rank between 2 and 4").join(leads.select("_run", "event", "place"), ["_run", "event"])
    links = support.groupBy("_run", "event", "place").agg(F.sort_array(F.collect_list(F.struct(
        "member_rank", M.item_link(F.when(T.text_or_empty(F.col("title")) != "", F.col("title")).otherwise(F.col("source")), F.col("url")).alias("l")))).alias("s"))
    aside = rows_to_lines(links, run, 1, F.col("place"), 1, _cat("   - 旁证：", F.array_join(F.transform("s", lambda x: x["l"]), " / ")))
    extras = topic_extras(marked.where("not lead"))
    order = marked.where("not lead").groupBy("_run", "category").agg(F.min("event_rank").alias("first_rank"))
    placed = extras.join(order, ["_run", "category"])
    topic = rows_to_lines(order, run, 3, F.col("first_rank"), 0, _cat("### ", F.col("category")))
    item = rows_to_lines(placed, run, 3, F.col("first_rank"), F.col("event_rank"), _cat("- ", F.col("link"), "｜", F.col("main.source")))
    gap = rows_to_lines(order, run, 3, F.col("first_rank"), F.lit(2**62), F.lit(""))
    return union_lines(fixed_lines(events, run, 0, [HEADLINES, "", LEDGER_NOTE, ""]), headline, aside,
                       fixed_lines(events, run, 2, ["", TOPICS_HEADING, ""]), topic, item, gap)


def topic_extras(others: DataFrame, per_topic: int = 3) -> DataFrame:
    """First events of every topic that are no headlines."""
    return top_k(others, ["_run", "category"], [F.col("event_rank")], per_topic)


def statistics_lines(items: DataFrame, categories: DataFrame, top: int = 12) -> DataFrame:
    """(ord, line) of the statistics section of one corpus."""
    stats = platform_statistics(items, categories, top)
    shown = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "name"))),
                                     lambda x: F.concat(F.lit("`"), x["name"], F.lit("` "), (-x["k"]).cast("string"))), "、")
    by_kind = stats.groupBy("kind").agg(shown.alias("shown"))
    head = items.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("s"))
    first = head.select(F.lit(2).alias("ord"), F.format_string("- 总计：%d 条，来自 %d 个信息源。", "n", "s").alias("line"))
    rest = by_kind.select(F.when(F.col("kind") == "source", 3).otherwise(4).alias("ord"),
                          _cat(F.when(F.col("kind") == "source", "- 信息源分布：").otherwise("- 分类分布："), F.col("shown"), "。").alias("line"))
    spark = items.sparkSession
    frame = spark.createDataFrame([(0, "## 平台统计"), (1, ""), (5, ""), (6, "---"), (7, "")], "ord INT, line STRING")
    return frame.unionByName(first).unionByName(rest)


def health_section(health: DataFrame) -> DataFrame:
    """(ord, line) of the source health section."""
    lines = health_lines(health)
    counts = lines.agg(F.count_if(F.col("state") == "recovered").alias("r"), F.count_if(F.col("state") == "failed").alias("f"))
    notes = counts.select(F.explode(F.array_compact(F.array(
        F.when((F.col("r") == 0) & (F.col("f") == 0), F.struct(F.lit(2).alias("ord"), F.lit("- 本次未发现不可用信息源；所有 enabled sources 至少完成采集流程。").alias("line"))),
        F.when(F.col("r") > 0, F.struct(F.lit(2).alias("ord"), F.lit("- 已自动修复/重试成功的信息源：").alias("line"))),
        F.when(F.col("f") > 0, F.struct(F.lit(4).alias("ord"), F.lit("- 仍不可用、需要后续处理的信息源：").alias("line")))))).alias("x")).select("x.*")
    body = lines.select(F.when(F.col("state") == "recovered", 3).otherwise(5).alias("ord"), F.col("text").alias("line"))
    head = health.limit(1).select(F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit("## 信息源可用性与自修复").alias("line")),
                                                    F.struct(F.lit(1).alias("ord"), F.lit("").alias("line")))).alias("x")).select("x.*")
    return head.unionByName(notes).unionByName(body)


def calendar_lines(window: DataFrame) -> DataFrame:
    """(ord, line) of the industry event section, from ``event_window`` rows."""
    titles = {"upcoming": "### 未来窗口", "recent": "### 近期已发生 / 需要补课", "undated": "### 时间待公布 / 持续关注"}
    place = F.when(F.col("bucket") == "upcoming", 100).when(F.col("bucket") == "recent", 200).otherwise(300)
    heading = F.lit(None).cast("string")
    for name, shown in titles.items():
        heading = F.when(F.col("bucket") == name, shown).otherwise(heading)
    body = window.select((place + F.col("slot") + 1).alias("ord"), "line")
    heads = window.select("bucket").distinct().select(F.explode(F.array(
        F.struct(place.alias("ord"), heading.alias("line")), F.struct((place + 1).alias("ord"), F.lit("").alias("line")),
        F.struct((place + 99).alias("ord"), F.lit("").alias("line")))).alias("x")).select("x.*")
    empty = window.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array_compact(F.array(
        F.struct(F.lit(0).alias("ord"), F.lit(f"## 2. {EVENTS_HEADING}").alias("line")), F.struct(F.lit(1).alias("ord"), F.lit("").alias("line")),
        F.when(F.col("n") == 0, F.struct(F.lit(2).alias("ord"), F.lit("- 暂无进入当前窗口的重点产业事件。").alias("line")))))).alias("x")).select("x.*")
    return empty.unionByName(heads).unionByName(body)


THEME_HEADING = r"(?m)^##\s*(?:(?:2|3)[\.、]\s*)?(主题与分类精选.*)$"


def insert_section(reports: DataFrame, section: Column, key: str = "report_id") -> DataFrame:
    """Section before the themes, themes renumbered; at the end when there are none; never twice."""
    text = F.concat(T.strip(T.text_or_empty(F.col("markdown"))), F.lit("\n"))
    title = F.trim(F.regexp_extract(text, THEME_HEADING, 1))
    found = F.regexp_substr(text, F.lit(THEME_HEADING))
    at = F.instr(text, found)
    before, after = F.substr(text, F.lit(1), at - 1), F.substr(text, at + F.length(found))
    out = (F.when(T.strip(section) == "", F.col("markdown")).when(text.contains(EVENTS_HEADING), text)
           .when(found.isNull(), _cat(F.regexp_replace(text, r"\s+$", ""), "\n\n", section))
           .otherwise(_cat(before, section, "## 3. ", title, after)))
    return reports.withColumn("markdown", out)


def supplement_lines(missing: DataFrame, reports: DataFrame, key: str = "report_id") -> DataFrame:
    """Lines that append the missing must-cover rows; nothing for reports that miss none."""
    number = F.when(F.col("markdown").contains(EVENTS_HEADING), 4).otherwise(3)
    heads = missing.select(key).distinct().join(reports, key).select(
        key, F.posexplode(F.array(F.lit(""), _cat("## ", number.cast("string"), ". 仍值得保留的补充信号"), F.lit(""), F.lit(SUPPLEMENT_NOTE), F.lit(""))).alias("a", "line"))
    head = heads.select(key, F.lit(0).alias("part"), F.col("a").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "line")
    meta = F.concat_ws(" / ", F.nullif("category", F.lit("")), F.nullif("source", F.lit("")))
    reason = T.compact_inline(F.col("reason"), 160) if "reason" in missing.columns else F.lit("")
    line = _cat("- ", M.item_link(F.col("title"), F.col("url"), 120), "｜", meta, F.when(reason != "", _cat("：", reason)).otherwise(""))
    return head.unionByName(rows_to_lines(missing, [key], 1, F.col("priority"), 0, line))


def chunk_lines(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Deterministic summary lines per chunk: best rows, category signals, first rows of each category. The rows are written once, as
    all kinds of lines read them."""
    rows = cut_lineage(rows)
    shown = chunk_rows(rows, by).withColumn("link", M.item_link(F.col("event_title"), F.col("url")))
    suffix = F.when(T.text_or_empty(F.col("reason")) != "", _cat("：", F.col("reason"))).otherwise("")
    meta = F.concat_ws(" / ", F.nullif("category", F.lit("")), F.nullif("source", F.lit("")))
    best = rows_to_lines(shown.where("kind = 'best'"), by, 1, F.col("place"), 0, _cat("- ", F.col("link"), "｜", meta, suffix))
    signals = category_signals(rows, by)
    sw = Window.partitionBy(*by).orderBy(F.col("n").desc(), "category")
    signal = rows_to_lines(signals.withColumn("place", F.row_number().over(sw)), by, 3, F.col("place"), 0,
                           _cat("- ", F.col("category"), "：本分块 ", F.col("n").cast("string"), " 条，优先查看该分类高分条目。"))
    firsts = rows.groupBy(*by, "category").agg(F.min("ord").alias("first_ord"))
    title = rows_to_lines(firsts, by, 5, F.col("first_ord"), 0, _cat("#### ", F.col("category")))
    group = shown.where("kind = 'category'").join(firsts, [*by, "category"])
    member = rows_to_lines(group, by, 5, F.col("first_ord"), F.col("place"), _cat("- ", F.col("link"), suffix))
    return union_lines(fixed_lines(rows, by, 0, ["### 重要候选"]), best, fixed_lines(rows, by, 2, ["", "### 主题信号"]), signal,
                       fixed_lines(rows, by, 4, ["", "### 分类补充"]), title, member)


def raw_listing_lines(rows: DataFrame, by: Sequence[str], per_category: int = 30) -> DataFrame:
    """Up to 30 rows per category in ledger order (needs category, ord, event_title, url, source, reason)."""
    sizes = rows.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))
    short = top_k(rows, [*by, "category"], [F.col("ord")], per_category).join(sizes, [*by, "category"])
    title = rows_to_lines(sizes, by, 1, F.col("first_ord"), 0, _cat("### ", F.col("category"), " (", F.col("n").cast("string"), " items)"))
    source = F.when(T.text_or_empty(F.col("source")) != "", _cat(" — ", F.col("source"))).otherwise("")
    item = rows_to_lines(short, by, 1, F.col("first_ord"), F.col("ord") * 2 + 1, _cat("- **", M.item_link(F.col("event_title"), F.col("url")), "**", source))
    text = F.substring(T.text_or_empty(F.col("reason")), 1, 150)
    note = rows_to_lines(short, by, 1, F.col("first_ord"), F.col("ord") * 2 + 2, F.when(text != "", _cat("  > ", text, "...")))
    return union_lines(fixed_lines(rows, by, 0, [RAW_HEAD, "", RAW_NOTE, ""]), title, item, note)


def category_section(items: DataFrame, max_items: int = 20) -> DataFrame:
    """(category, a, line): items of a category with a 200-character preview. Needs category, category_rank."""
    short = items.where(F.col("category_rank") <= max_items)
    head = items.select("category").distinct().select("category", F.lit(0).cast("bigint").alias("a"), _cat("## ", F.col("category")).alias("line"))
    line = _cat("- ", M.item_line(F.col("title"), F.col("author"), F.col("url"), F.col("score")))
    text = T.text_or_empty(F.col("content"))
    preview = F.concat(F.replace(F.substring(text, 1, 200), F.lit("\n"), F.lit(" ")), F.when(F.length(text) > 200, "...").otherwise(""))
    rows = F.array_compact(F.array(
        F.struct((F.col("category_rank") * 3).cast("bigint").alias("a"), line.alias("line")),
        F.when(text != "", F.struct((F.col("category_rank") * 3 + 1).cast("bigint").alias("a"), _cat("  > ", preview).alias("line"))),
        F.struct((F.col("category_rank") * 3 + 2).cast("bigint").alias("a"), F.lit("").alias("line"))))
    return head.unionByName(short.select("category", F.explode(rows).alias("x")).select("category", "x.*"))


# Labels of the ranking signals.
SIGNAL_LABELS = {
    "reading_count": "在读人数", "rating_count": "评价人数", "ratings_count": "评分人数", "rating": "评分", "star_rating": "星级",
    "rank_bonus": "榜单名次加分", "rating_bonus": "评分加分", "finished": "完读率修正", "rating_percent": "评分率修正",
    "recommend_percent": "推荐率修正", "free_ratio": "免费占比修正", "ai_keypoint_coverage": "AI 要点覆盖修正",
}


def ranking_summary(base_signal: Column, base_score: Column, multiplier: Column, factors: Column) -> Column:
    """One sentence that explains a ranking from its base signal, additive and multiplying factors; null when
    there is nothing to say. ``factors`` is a map of name to number."""
    labels = F.create_map(*[x for k, v in SIGNAL_LABELS.items() for x in (F.lit(k), F.lit(v))])
    label = lambda k: F.coalesce(F.try_element_at(labels, k), k)
    entries = F.map_entries(F.coalesce(factors, F.expr("cast(map() as map<string,double>)")))
    added = F.transform(F.filter(entries, lambda e: e["key"].contains("bonus")), lambda e: F.concat(label(e["key"]), F.lit(" +"), T.metric_text(e["value"])))
    scaled = F.transform(F.filter(entries, lambda e: ~e["key"].contains("bonus")),
                         lambda e: F.concat(label(e["key"]), F.lit(" "), F.format_string("%+.3f", e["value"])))
    base = F.when((T.text_or_empty(base_signal) != "") & base_score.isNotNull(), _cat("基础热度主要来自", label(base_signal), " ", T.metric_text(base_score)))
    extra = F.when(F.size(added) > 0, _cat("另有", F.array_join(added, "、")))
    far = F.abs(multiplier - 1.0) >= 0.001
    scale = (F.when(far, _cat("并由 ", F.when(F.size(scaled) > 0, F.array_join(scaled, "、")).otherwise("若干口碑/完成度因子"), " 带来约 ",
                              F.format_string("%.3f", multiplier), "x 的轻微修正"))
             .when(multiplier.isNotNull() & (F.size(scaled) > 0), _cat("并参考 ", F.array_join(scaled, "、"))))
    bits = F.concat_ws("；", base, extra, scale)
    return F.when(bits != "", _cat(bits, "。"))


def item_payload(weight: Column) -> Column:
    """Projection of an item as a struct; null members vanish in JSON."""
    author = F.nullif(T.text_or_empty(F.col("author")), F.lit(""))
    return F.struct(
        M.display_title(F.col("title")).alias("title"), "source", "url", F.substring("content", 1, 300).alias("content"), "score",
        weight.alias("source_weight"), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("published_at"), "tags", author.alias("author"))


# --- short message -------------------------------------------------------------------------------------

# Sections of the short message, and headings its table of contents leaves out.
MESSAGE_SECTIONS = [["平台统计"], ["信息源可用性与自修复"], ["1. Today's Top 10 Headlines"]]
MESSAGE_SKIP = ["平台统计", "信息源可用性与自修复", "今日精选日报", "1. Today's Top 10 Headlines", "Token 使用与费用"]


def other_headings(reports: DataFrame, key: str = "report_id", limit: int = 18) -> DataFrame:
    """First second- and third-level headings that are not sent in full."""
    lines = M.line_table(reports, key).where(F.col("level").isin(2, 3) & ~F.col("heading").isin(*MESSAGE_SKIP))
    short = top_k(lines, [key], [F.col("ord")], limit)
    shown = F.concat(F.when(F.col("level") == 2, "- ").otherwise("  - "), F.col("heading"))
    packed = short.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ord", shown.alias("t")))).alias("h"))
    return packed.select(key, F.array_join(F.transform("h", lambda x: x["t"]), "\n").alias("headings"))


def short_message(reports: DataFrame, footer: Column | str, feed_url: str = "", key: str = "report_id", limit: int = 12_000) -> DataFrame:
    """(key, message): chosen sections, other headings, plain links, cut so that the footer survives. Reports
    need markdown, date, generated_at, items_count, sources_count."""
    out = reports.select(key, "markdown", "date", "generated_at", "items_count", "sources_count")
    names = []
    for i, wanted in enumerate(MESSAGE_SECTIONS):
        out = out.join(M.heading_section(reports, wanted, key).withColumnRenamed("section", f"s{i}"), key, "left")
        names.append(F.nullif(F.col(f"s{i}"), F.lit("")))
    out = out.join(other_headings(reports, key), key, "left")
    stamp = F.date_format(F.col("generated_at") + F.expr("interval 8 hours"), "yyyy-MM-dd HH:mm")
    head = _cat("# AI 早报 ", F.col("date"), "\n\n> Generated at ", stamp, " | ", F.col("items_count").cast("string"), " items from ",
                F.col("sources_count").cast("string"), " sources")
    toc = F.when(F.col("headings").isNotNull(), _cat("## 其余内容标题\n\n", F.col("headings")))
    feed = F.lit(f"完整版见 RSS：{feed_url.rstrip('/')}/feed") if feed_url else F.lit(None).cast("string")
    has = F.coalesce(*names).isNotNull()
    body = F.when(has, F.concat_ws("\n\n---\n\n", head, *names, toc, feed)).otherwise(F.col("markdown"))
    plain = out.select(key, M.clickable_text(body).alias("text"), _lit(footer).alias("footer"))
    budget = F.greatest(F.lit(limit) - F.length("footer") - 20, F.lit(1000))
    cut = F.when(F.length("text") > limit, _cat(F.substr("text", F.lit(1), budget), "\n\n[truncated]\n\n", F.col("footer")))
    closed = F.when(~F.right("text", F.lit(2000)).contains("Token 使用与费用"), _cat(F.regexp_replace(F.col("text"), r"\s+$", ""), "\n\n", F.col("footer")))
    return plain.select(key, F.coalesce(cut, closed, F.col("text")).alias("message"))
