"""Monthly, higher-period and case-based period reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import markdown as M, text as T
from briefwright.lexicon import Lexicon
from briefwright.operators.aggregates import report_keyword_counts, score_cases
from briefwright.operators.ranking import first_per, top_k
from briefwright.operators.themes import monthly_themes, reading_list, top_cases
from briefwright.plans.calendar import PERIOD_NAMES
from briefwright.session import cut_lineage
from briefwright.plans.reports import _cat, fixed_lines, rows_to_lines, union_lines

SCHEMA_VERSION = 2
# Section titles of the period reports, and default watch lines.
CONCLUSIONS, READING, WATCH, THEMES_TITLE, SLICES = "## 本期结论", "## 建议精读（原文入口）", "## 后续观察", "## 重点主题与案例", "## 月度切片与代表案例"
MONTH_WATCH = ["继续观察高频主题与跨来源重复出现的信号。", "优先补读高分代表项的一手资料。"]
PERIOD_WATCH = ["继续比较跨月反复出现的主题与叙事变化。", "对只出现一次的热点维持低权重。"]
FOLLOW_UPS = [
    "优先补读上面案例的一手原文，确认哪些只是舆论热度，哪些已经进入真实产品/工程落地。",
    "把跨多天重复出现、且来自不同来源的平台/模型/工具单独拉成持续跟踪名单。",
]


def theme_batches(themes: DataFrame, by: Sequence[str], size: int = 4) -> DataFrame:
    return themes.withColumn("batch", (F.floor((F.col("theme_rank") - 1) / size) + 1).cast("int"))


def batch_summary_lines(themes: DataFrame, theme_items: DataFrame, by: Sequence[str], size: int = 4) -> DataFrame:
    """(by, batch, place, line): one line per theme of a batch with its best item."""
    first = theme_items.where("item_rank = 1").select(*by, "theme", "title")
    rows = theme_batches(themes, by, size).join(first, [*by, "theme"])
    return rows.select(*by, "batch", F.col("theme_rank").alias("place"),
                       _cat(F.col("theme"), "：", F.col("n").cast("string"), " 条，代表项：", F.col("title")).alias("line"))


def conclusions(batch_lines: DataFrame, by: Sequence[str], limit: int) -> DataFrame:
    """First distinct lines of all batches."""
    unique = first_per(batch_lines.withColumn("line", F.trim("line")).where("line <> ''"), [*by, "line"], [F.col("place")])
    short = top_k(unique, by, [F.col("place")], limit)
    return short.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]).alias("conclusion_bullets"))


def period_meta(items: DataFrame, month: str = "month", lexicon: Lexicon | None = None, max_items: int = 180, max_themes: int = 12,
                batch_size: int = 4) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(metadata rows, theme tables): one row per month with counts, keywords, themes, bullets and cases."""
    by = [month]
    parts = monthly_themes(items, by, lexicon, max_items, max_themes)
    lines = batch_summary_lines(parts["themes"], parts["items"], by, batch_size)
    bullets = conclusions(lines, by, 5)
    ordered = lambda value, key: F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v")))), lambda x: x["v"])
    cases = top_cases(parts["items"]).withColumn("k", F.col("theme_rank") * 100 + F.col("item_rank"))
    case = F.struct("theme", "title", "source", "url", "content", "score")
    case_rows = top_k(cases, by, [F.col("k")], 8).groupBy(*by).agg(ordered(case, "k").alias("top_cases"))
    focus = parts["themes"].where("theme_rank <= 5").groupBy(*by).agg(ordered(F.col("theme"), "theme_rank").alias("focus_themes"))
    counts = parts["themes"].groupBy(*by).agg(F.count(F.lit(1)).alias("cluster_count"))
    words = parts["terms"].where("term_rank <= 12").groupBy(*by).agg(ordered(F.col("term"), "term_rank").alias("top_keywords"))
    kept = parts["kept"].groupBy(*by).agg(F.count(F.lit(1)).alias("selected_items"))
    total = items.groupBy(*by).agg(F.count(F.lit(1)).alias("total_items"))
    meta = total
    for part in (kept, counts, words, focus, bullets, case_rows):
        meta = meta.join(part, by, "left")
    watch = F.array(*[F.lit(x) for x in MONTH_WATCH])
    meta = meta.withColumns({"schema_version": F.lit(SCHEMA_VERSION), "watch_bullets": watch,
                             "batch_count": F.ceil(F.col("cluster_count") / batch_size).cast("int")})
    return cut_lineage(meta), parts


def _bullet_lines(meta: DataFrame, by: Sequence[str], part: int, column: str) -> DataFrame:
    return meta.select(*by, F.posexplode_outer(column).alias("a", "t")).select(
        *by, F.lit(part).alias("part"), F.coalesce("a", F.lit(0)).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"),
        _cat("- ", F.coalesce("t", F.lit("本月暂无足够数据。"))).alias("line"))


def _entry_lines(rows: DataFrame, by: Sequence[str], part: int, a: Column, b: Column, head: Column, note: str, chars: int | None = None) -> DataFrame:
    """A linked entry: title line, optional summary line, optional link line."""
    text = T.text_or_empty(F.col("content")) if chars is None else T.trim_text(F.col("content"), chars)
    url = T.text_or_empty(F.col("url"))
    return union_lines(
        rows_to_lines(rows, by, part, a, b, head),
        rows_to_lines(rows, by, part, a, b + 1, F.when(text != "", _cat(f"  - {note}：", text))),
        rows_to_lines(rows, by, part, a, b + 2, F.when(url != "", _cat("  - 原文：", url))))


def _source() -> Column:
    return F.when(T.text_or_empty(F.col("source")) != "", F.col("source")).otherwise("unknown")


def monthly_report_lines(items: DataFrame, meta: DataFrame, parts: dict[str, DataFrame], month: str = "month") -> DataFrame:
    """Line table of the monthly reports of all months at once."""
    by = [month]
    sources = items.groupBy(*by, "source").agg(F.count(F.lit(1)).alias("n"))
    main = top_k(sources, by, [F.col("n").desc(), F.col("source")], 6).groupBy(*by).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "source"))),
        lambda x: F.concat(x["source"], F.lit(" "), (-x["k"]).cast("string"))), " / ").alias("main_sources"))
    first = F.to_date(F.concat(F.col(month), F.lit("-01")))
    head = meta.join(main, by, "left").select(*by, F.posexplode(F.array(
        _cat("# AI 早报月报｜", F.col(month)), F.lit(""),
        _cat("- 覆盖周期：", first.cast("string"), " ~ ", F.last_day(first).cast("string")),
        _cat("- 原始条目数：", F.col("total_items").cast("string")), _cat("- 代表条目数：", F.coalesce("selected_items", F.lit(0)).cast("string")),
        _cat("- 主要来源：", F.coalesce("main_sources", F.lit("暂无"))), F.lit(""), F.lit(CONCLUSIONS))).alias("a", "line")).select(
        *by, F.lit(0).alias("part"), F.col("a").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "line")
    themes = parts["themes"].where("theme_rank <= 5")
    theme_head = rows_to_lines(themes, by, 3, F.col("theme_rank"), 0, _cat(
        "### ", F.col("theme"), "（", F.col("n").cast("string"), " 条，", F.col("source_variety").cast("string"), " 个来源）"))
    theme_gap = rows_to_lines(themes, by, 3, F.col("theme_rank"), 99, F.lit(""))
    best = parts["items"].where("theme_rank <= 5 and item_rank <= 2")
    entries = _entry_lines(best, by, 3, F.col("theme_rank"), F.col("item_rank") * 10, _cat("- [", _source(), "] ", F.col("title")), "摘要", 150)
    reads = reading_list(parts["items"], by)
    read = _entry_lines(reads, by, 5, F.col("theme_rank") * 1000 + F.col("item_rank") * 10, F.lit(0), _cat("- [", _source(), "] ", F.col("title")), "提示")
    return union_lines(head, _bullet_lines(meta, by, 1, "conclusion_bullets"), fixed_lines(meta, by, 2, ["", THEMES_TITLE]), theme_head, entries, theme_gap,
                       fixed_lines(meta, by, 4, [READING]), read, fixed_lines(meta, by, 6, ["", WATCH]), _bullet_lines(meta, by, 7, "watch_bullets"))


def compact_months(meta: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """Compact month rows; fields the metadata lacks come from the sections of the report text."""
    rows = meta
    if reports is None:
        return rows
    fill = lambda titles, n: F.coalesce(*[F.when(F.size(M.section_bullets(F.col("markdown"), t, n)) > 0, M.section_bullets(F.col("markdown"), t, n)) for t in titles])
    parsed = reports.select("month", fill(["本期结论", "核心观察"], 4).alias("_c"), fill(["主题聚焦"], 5).alias("_f"),
                            fill(["后续观察", "值得继续调研"], 3).alias("_w"))
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    joined = rows.join(parsed, "month", "full_outer")
    return joined.withColumns({
        "conclusion_bullets": F.coalesce(some("conclusion_bullets"), "_c"), "focus_themes": F.coalesce(some("focus_themes"), "_f"),
        "watch_bullets": F.coalesce(some("watch_bullets"), "_w")}).drop("_c", "_f", "_w")


def higher_period_lines(months: DataFrame, period: str, key: str = "period_key") -> DataFrame:
    """Line table of quarter, half-year or year reports, from month rows that carry their period key."""
    by = [key]
    order = F.row_number().over(Window.partitionBy(*by).orderBy("month"))
    rows = months.withColumn("place", order)
    bounds = rows.groupBy(*by).agg(F.min("month").alias("lo"), F.max("month").alias("hi"), F.count(F.lit(1)).alias("n"),
                                   F.array_join(F.sort_array(F.collect_list("month")), " / ").alias("names"))
    head = bounds.select(*by, F.posexplode(F.array(
        _cat(f"# AI 早报{PERIOD_NAMES[period]}｜", F.col(key)), F.lit(""),
        _cat("- 覆盖周期：", F.col("lo"), "-01 ~ ", F.last_day(F.to_date(F.concat("hi", F.lit("-01")))).cast("string")),
        _cat("- 纳入月报数：", F.col("n").cast("string")), _cat("- 覆盖月份：", F.col("names")), F.lit(""), F.lit(CONCLUSIONS))).alias("a", "line")).select(
        *by, F.lit(0).alias("part"), F.col("a").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "line")
    lead = F.coalesce(F.try_element_at("focus_themes", F.lit(1)), F.try_element_at("conclusion_bullets", F.lit(1)), F.lit("无明显主题"))
    bullets = rows_to_lines(rows.where("place <= 6"), by, 1, F.col("place"), 0, _cat("- ", F.col("month"), "：", lead))
    month_head = rows_to_lines(rows, by, 3, F.col("place"), 0, _cat("### ", F.col("month")))
    concl = F.try_element_at("conclusion_bullets", F.lit(1))
    month_concl = rows_to_lines(rows, by, 3, F.col("place"), 1, _cat("- 月度结论：", concl))
    flat = rows.select(*by, "month", "place", F.posexplode("top_cases").alias("i", "c")).select(*by, "month", "place", "i", "c.*")
    titled = F.when(T.text_or_empty(F.col("title")) != "", F.col("title")).otherwise("（无标题）")
    cases = _entry_lines(flat.where("i < 2"), by, 3, F.col("place"), F.col("i") * 10 + 10, _cat("- [", _source(), "] ", titled), "摘要")
    gap = rows_to_lines(rows, by, 3, F.col("place"), 99, F.lit(""))
    reads = reading_cases(flat, by)
    read = _entry_lines(reads, by, 5, F.col("place") * 1000 + F.col("i") * 10, F.lit(0), _cat("- [", F.col("month"), "] [", _source(), "] ", titled), "提示")
    return union_lines(head, bullets, fixed_lines(rows, by, 2, ["", SLICES]), month_head, month_concl, cases, gap,
                       fixed_lines(rows, by, 4, [READING]), read, fixed_lines(rows, by, 6, ["", WATCH, *[f"- {x}" for x in PERIOD_WATCH]]))


def reading_cases(flat: DataFrame, by: Sequence[str], limit: int = 10) -> DataFrame:
    """First distinct cases of the months of a period."""
    key = F.when(T.text_or_empty(F.col("url")) != "", F.col("url")).otherwise(T.text_or_empty(F.col("title")))
    unique = first_per(flat.withColumn("_k", key).where("_k <> ''"), [*by, "_k"], [F.col("place"), F.col("i")]).drop("_k")
    return top_k(unique, by, [F.col("place"), F.col("i")], limit)


def case_report_lines(reports: DataFrame, start, end, period_key: str, period: str, lexicon: Lexicon | None = None) -> DataFrame:
    """Line table of a period report from the cases of its daily reports (report_id = file name, markdown)."""
    lexicon = lexicon or Lexicon()
    run = ["period_key"]
    tag = lambda df: df.withColumn("period_key", F.lit(period_key))
    # each table is used by several of the next: written once instead of computed again
    cases = cut_lineage(M.extract_cases(reports))
    counts = cut_lineage(report_keyword_counts(cases, lexicon))
    scored = cut_lineage(score_cases(cases, counts, lexicon))
    order = [F.col("case_score").desc(), F.col("title_length"), F.col("report_id"), F.col("pos")]
    best = scored.orderBy(*order).limit(10).withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    best = cut_lineage(tag(best))
    size = lambda df, name: df.agg(F.count(F.lit(1)).alias(name)).withColumn("_one", F.lit(1))
    totals = size(reports, "files").join(size(scored, "cases"), "_one").drop("_one")
    words = counts.orderBy(F.col("n").desc(), "first_seen").limit(3).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "first_seen", "word"))), lambda x: x["word"]), "、").alias("focus"))
    name = PERIOD_NAMES[period]
    head = tag(totals).select(*run, F.posexplode(F.array(
        F.lit(f"# AI 早报{name}｜{period_key}"), F.lit(""), F.lit(f"- 覆盖周期：{start} ~ {end}"), _cat("- 纳入日报数：", F.col("files").cast("string")),
        _cat("- 可追溯案例数：", F.col("cases").cast("string")), F.lit(""), F.lit(CONCLUSIONS))).alias("a", "line")).select(
        *run, F.lit(0).alias("part"), F.col("a").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "line")
    lead = rows_to_lines(best.where("place <= 6"), run, 1, F.col("place"), 0, _cat("- ", F.col("title")))
    section = F.when(F.col("section") != "", F.col("section")).otherwise("未分类")
    body = union_lines(
        rows_to_lines(best, run, 3, F.col("place"), 0, _cat("- [", section, "] ", F.col("title"))),
        rows_to_lines(best, run, 3, F.col("place"), 1, F.when(F.col("snippet") != "", _cat("  - 摘要：", F.col("snippet")))),
        rows_to_lines(best, run, 3, F.col("place"), 2, _cat("  - 原文：", F.col("url"))),
        rows_to_lines(best, run, 3, F.col("place"), 3, _cat("  - 来源日报：", F.col("report_id"))))
    files = tag(reports).select(*run, F.lit(5).alias("part"), F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), _cat("- ", F.col("report_id")).alias("line"))
    last = F.when(F.coalesce("focus", F.lit("")) != "", _cat(f"- 下一个{name}优先继续追踪：", F.col("focus"), "。")).otherwise(
        f"- 下一个{name}继续观察高频重复主题与一次性热点的分化。")
    follow = tag(words).select(*run, F.posexplode(F.array(*[F.lit(f"- {x}") for x in FOLLOW_UPS], last)).alias("a", "line")).select(
        *run, F.lit(7).alias("part"), F.col("a").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "line")
    frame = tag(totals)
    return union_lines(head, lead, fixed_lines(frame, run, 2, ["", "## 代表案例与原文"]), body, fixed_lines(frame, run, 4, ["", "## 日报入口"]), files,
                       fixed_lines(frame, run, 6, ["", WATCH]), follow)
