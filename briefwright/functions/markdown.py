"""Markdown columns and line tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType

from briefwright.functions import text as T
from briefwright.functions.urls import percent_encode
from briefwright.lexicon import any_substring, let


def clean_label(label: Column) -> Column:
    """No square brackets in a link label; ``link`` when nothing is left."""
    bare = lambda value: T.strip(F.regexp_replace(value, r"[\[\]]", ""))
    text = let(label, lambda x: F.when(T.text_or_empty(x) == "", F.lit("link")).otherwise(x))
    return let(bare(text), lambda x: F.when(x == "", "link").otherwise(x))


def display_title(title: Column) -> Column:
    """First non-empty line without links, list marks and brackets."""
    raw = T.strip(F.regexp_replace(T.text_or_empty(title), r"https?://\S+", ""))
    lines = lambda text: F.filter(F.transform(F.split(text, r"\R"), lambda x: T.strip(x)), lambda x: x != "")
    first = let(raw, lambda text: F.coalesce(F.try_element_at(lines(text), F.lit(1)), text))
    bare = T.strip(F.regexp_replace(first, r"^[-*•]\s+", ""))
    return T.compact_inline(clean_label(bare))


def markdown_link(label: Column, url: Column) -> Column:
    target = T.strip(T.text_or_empty(url))
    web = target.startswith("http://") | target.startswith("https://")
    return let(clean_label(label), lambda x: F.when(web, F.concat(F.lit("["), x, F.lit("]("), percent_encode(target), F.lit(")"))).otherwise(x))


def item_link(title: Column, url: Column, max_chars: int | None = None) -> Column:
    """Linked display title, plain when the row has no link."""
    shown = display_title(title)
    if max_chars:
        shown = let(shown, lambda x: F.when(F.length(x) > max_chars, F.concat(F.rtrim(F.substring(x, 1, max_chars - 1)), F.lit("…"))).otherwise(x))
    return let(shown, lambda x: F.when(T.strip(T.text_or_empty(url)) != "", markdown_link(x, url)).otherwise(x))


def item_line(title: Column, author: Column, url: Column, score: Column) -> Column:
    """Title, author, link and points, missing parts left out."""
    text = T.text_or_empty
    return F.concat_ws(
        " | ", F.concat(F.lit("**"), text(title), F.lit("**")),
        F.when(text(author) != "", F.concat(F.lit("by "), author)),
        F.when(text(url) != "", F.concat(F.lit("[link]("), url, F.lit(")"))),
        F.when(score > 0, F.concat(F.lit("("), F.format_string("%d", F.bround(score, 0).cast("bigint")), F.lit(" pts)"))))


def section_body(md: Column, title: str, level: int = 2) -> Column:
    """Text below a heading of the given level and exact title, up to the next heading of that level."""
    mark = "#" * level
    return F.regexp_extract(T.text_or_empty(md), rf"(?ms)^{mark}\s+{_quoted(title)}\n(.*?)(?=^{mark}\s+|\z)", 1)


def section_bullets(md: Column, title: str, limit: int | None = None, level: int = 2) -> Column:
    lines = F.transform(F.split(section_body(md, title, level), r"\R"), lambda x: T.strip(x))
    found = F.transform(F.filter(lines, lambda x: x.startswith("- ")), lambda x: T.strip(F.substr(x, F.lit(3))))
    return F.slice(found, 1, limit) if limit else found


def _quoted(text: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|/" else ch for ch in text)


def line_table(reports: DataFrame, key: str = "report_id", md: str = "markdown") -> DataFrame:
    """One row per line: (key, ord, line, level, heading); level and heading are null for plain lines."""
    lines = reports.select(key, F.posexplode(F.split(F.coalesce(md, F.lit("")), r"\R")).alias("ord", "line"))
    level = F.length(F.regexp_extract("line", r"^\s*(#{1,6})\s+\S", 1))
    return lines.withColumn("level", F.when(level > 0, level)).withColumn(
        "heading", F.when(F.col("level").isNotNull(), T.strip(F.regexp_replace("line", r"^\s*#{1,6}\s+", ""))))


def _to_here(key: str) -> Window:
    return Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)


def covered(lines: DataFrame, marked: str, key: str = "report_id") -> Column:
    """Is the line under a marked heading (or is it that heading)? A heading covers all lines up to the next
    heading of its level or above: it is then the latest heading among those of its level or above."""
    out = F.lit(False)
    for level in range(1, 7):
        latest = F.last(F.when(F.col("level") <= level, F.struct(F.col("level"), F.col(marked).alias("m"))), ignorenulls=True).over(_to_here(key))
        out = out | F.coalesce(latest["m"] & (latest["level"] == level), F.lit(False))
    return out


def join_lines(lines: DataFrame, key: str = "report_id", name: str = "markdown") -> DataFrame:
    """Lines of a report back to one text."""
    packed = lines.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ord", "line"))).alias("l"))
    return packed.select(key, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias(name))


# Sections a report must not have, and the front statistics section.
FORBIDDEN_SECTIONS = ["重要性与交叉验证", "高权重主题/分类", "重要候选信息", "Platform Statistics"]
STATISTICS_TITLE = "平台统计"


def heading_section(reports: DataFrame, wanted: Sequence[str], key: str = "report_id", md: str = "markdown") -> DataFrame:
    """(key, section): the first heading with a wanted title and its subtree, rules (---) left out."""
    lines = line_table(reports, key, md)
    hit = F.col("heading").isin(*wanted)
    first = F.min(F.when(hit, F.col("ord"))).over(Window.partitionBy(key))
    lines = lines.withColumn("is_start", F.coalesce(F.col("ord") == first, F.lit(False)))
    body = lines.withColumn("inside", covered(lines, "is_start", key)).where("inside and trim(line) <> '---'")
    out = join_lines(body, key, "section")
    return out.select(key, T.strip("section").alias("section"))


def clean_structure(reports: DataFrame, key: str = "report_id", md: str = "markdown") -> DataFrame:
    """Forbidden sections removed with their subtree, old headings folded, only the first statistics section kept."""
    lines = line_table(reports, key, md)
    level = F.length(F.regexp_extract(T.strip("line"), "^(#{2,6})", 1))
    lines = lines.withColumns({
        "level": F.when(level > 0, level),
        "heading": F.when(level > 0, T.strip(F.regexp_replace(T.strip("line"), "^#{2,6}", "")))})
    forbidden = any_substring(F.col("heading"), FORBIDDEN_SECTIONS)
    lines = lines.withColumn("_bad", F.coalesce(forbidden, F.lit(False)))
    lines = lines.withColumn("_cut", covered(lines, "_bad", key)).where("not _cut")
    folded = lines.withColumn("line", F.regexp_replace("line", r"^##\s*(?:\d+[\.、]\s*)?跨平台主题分析\s*$", "## 2. 主题与分类精选"))
    folded = folded.withColumn("line", F.regexp_replace("line", r"^###?\s*(?:\d+[\.、]\s*)?分类详情\s*$", "### 分类补充"))
    is_stats = F.regexp_replace(F.col("heading"), r"^\d+[\.、]\s*", "") == STATISTICS_TITLE
    seen = F.sum(F.when(is_stats, 1).otherwise(0)).over(_to_here(key))
    folded = folded.withColumn("_again", F.coalesce(is_stats & (seen > 1), F.lit(False)))
    kept = folded.withColumn("_cut", covered(folded, "_again", key)).where("not _cut")
    out = join_lines(kept, key, "markdown")
    return out.select(key, F.concat(F.regexp_replace("markdown", r"^\s+|\s+$", ""), F.lit("\n")).alias("markdown"))


# --- links inside a text -------------------------------------------------------------------------------

_LINK = re.compile(r"\[((?:[^\[\]]|\[[^\]]*\])+)\]\((?:<([^>]+)>|([^)]+))\)")
_BARE = re.compile(r"(?<![<(])https?://[^\s<>]+")
_SAFE = ":/?#@!$&'*,;=%+"


def _parts(found: re.Match) -> tuple[str, str]:
    label = found[1].strip().replace("[", "").replace("]", "").strip() or "link"
    return label, (found[2] or found[3] or "").strip()


def _web(url: str) -> bool:
    return url.startswith(("http://", "https://"))


def _plain_links(text: str) -> str:
    def link(found: re.Match) -> str:
        label, url = _parts(found)
        return f"[{label}]({quote(url, safe=_SAFE)})" if _web(url) else found[0]

    def bare(found: re.Match) -> str:
        url = found[0].rstrip(".,;:!?")
        extra = url.count(")") - url.count("(")
        while extra > 0 and url.endswith(")"):
            url, extra = url[:-1], extra - 1
        return f"[link]({quote(url, safe=_SAFE)}){found[0][len(url):]}"

    return _BARE.sub(bare, _LINK.sub(link, text))


@F.pandas_udf(StringType())
def plain_links(md: pd.Series) -> pd.Series:
    """Every link in ``[label](url)`` form; bare URLs are wrapped, trailing punctuation stays outside."""
    return md.fillna("").map(_plain_links)


@F.pandas_udf(ArrayType(StringType()))
def link_targets(md: pd.Series) -> pd.Series:
    return md.fillna("").map(lambda text: list(dict.fromkeys(u for _, u in map(_parts, _LINK.finditer(text)) if _web(u))))


@F.pandas_udf(StringType())
def without_links(md: pd.Series, dead: pd.Series) -> pd.Series:
    """Links to dead targets become their label."""
    def one(text: str, gone: set[str]) -> str:
        def link(found: re.Match) -> str:
            label, url = _parts(found)
            return label if url in gone else found[0]
        return _LINK.sub(link, text)

    return pd.Series([one(t or "", set(d if d is not None else ())) for t, d in zip(md, dead)], dtype="object")


@F.pandas_udf(StringType())
def clickable_text(md: pd.Series) -> pd.Series:
    """Links as ``label：url `` for plain-text channels, emphasis marks dropped."""
    def one(text: str) -> str:
        def link(found: re.Match) -> str:
            label, url = _parts(found)
            return f"{label}：{url} " if _web(url) else found[0]
        return _LINK.sub(link, text).replace("**", "")

    return md.fillna("").map(one)


def sanitise_links(reports: DataFrame, url_status: DataFrame, key: str = "report_id") -> DataFrame:
    """Plain links everywhere; targets whose status is missing or dead are reduced to their label."""
    plain = reports.select(key, plain_links("markdown").alias("markdown"))
    targets = plain.select(key, F.explode(F.array_distinct(link_targets("markdown"))).alias("url"))
    dead = (targets.join(url_status.select("url", "is_open"), "url", "left").where("not coalesce(is_open, false)")
            .groupBy(key).agg(F.collect_list("url").alias("dead")))
    return plain.join(dead, key, "left").select(key, without_links("markdown", "dead").alias("markdown"))


# --- quality flags -------------------------------------------------------------------------------------

# Refusal phrases, and endings that mean a cut-off text.
REFUSALS = [
    "i'm sorry", "i cannot assist", "i can't assist", "i'm not able to", "i apologize, but", "as an ai",
    "i cannot help with", "i'm unable to",
]
BROKEN_ENDINGS = ["[", "(", "{", '"', "“", "—", ":"]
RAW_MARK = "<!-- RAW_FALLBACK_REPORT -->"


def is_truncated(md: Column) -> Column:
    text = F.regexp_replace(T.text_or_empty(md), r"(?U)\s+$", "")
    count = lambda mark: F.size(F.split(text, mark)) - 1
    broken = F.lit(False)
    for ending in BROKEN_ENDINGS:
        broken = broken | text.endswith(ending)
    broken = broken | (text.endswith("*") & ~text.endswith("**")) | (text.endswith("`") & ~text.endswith("```"))
    odd = (count("```") % 2 != 0) | (count(r"\*\*") % 2 != 0)
    return F.when(T.text_or_empty(md) == "", True).when(text.contains(RAW_MARK), False).otherwise(odd | broken)


def is_refusal(md: Column) -> Column:
    low = F.lower(T.text_or_empty(md))
    return (F.length(md) <= 500) & any_substring(low, REFUSALS)


def digest_fault(md: Column, top_n: int = 10) -> Column:
    """First reason why a text is no usable digest; null when it is one."""
    text = F.regexp_replace(T.text_or_empty(md), r"(?U)^\s+|\s+$", "")
    after = F.substr(text, F.instr(text, "Today's Top") + len("Today's Top"))
    top = F.substring_index(after, "## 2.", 1)
    headlines = F.size(F.filter(F.split(top, r"\R"), lambda x: x.rlike(r"^\s*(?:[-*]|\d+[.)])\s+")))
    out = F.when(is_truncated(text), "truncated_or_broken_markdown").when(F.length(text) < 800, "too_short_for_digest")
    for name in FORBIDDEN_SECTIONS:
        out = out.when(text.contains(name), f"forbidden_section:{name}")
    return (out.when(~text.contains("Today's Top"), "missing_top_headlines")
            .when(~text.contains("主题与分类精选"), "missing_theme_section")
            .when(headlines < max(3, min(top_n, 6)), F.concat(F.lit("too_few_top_headlines:"), headlines.cast("string")))
            .when(~top.contains("http"), "top_headlines_missing_links"))


def chunk_fault(md: Column) -> Column:
    text = F.regexp_replace(T.text_or_empty(md), r"(?U)^\s+|\s+$", "")
    return (F.when(is_truncated(text), "truncated_or_broken_markdown").when(F.length(text) < 80, "too_short")
            .when(~text.contains("重要候选") & ~text.contains("分类补充"), "missing_chunk_sections"))


# --- cases of a report ---------------------------------------------------------------------------------

# Prefixes that mark a detail line, and tags of link and summary lines.
DETAIL_PREFIXES = ["原文：", "链接：", "链接/作者：", "作者/链接：", "提示：", "摘要："]
LINK_TAGS = ["原文", "链接", "作者", "详见", "详情"]
SNIPPET_TAGS = ["摘要：", "提示：", "总结", "简述"]


def extract_cases(reports: DataFrame, key: str = "report_id", md: str = "markdown") -> DataFrame:
    """(key, pos, title, url, section, snippet): top bullets with their link and summary, which may stand on
    the lines below. A heading or the next top bullet ends a case."""
    has_any = any_substring
    lines = reports.select(key, F.posexplode(F.split(F.coalesce(md, F.lit("")), r"\R")).alias("ord", "raw"))
    lines = lines.withColumns({"line": F.rtrim("raw"), "bare": T.strip("raw")}).where("bare <> ''")
    lines = lines.withColumns({
        "is_section": F.col("bare").startswith("## ") | F.col("bare").startswith("### "),
        "is_top": F.col("line").rlike(r"^\s*(?:- |\d+\.\s+)") & ~F.col("line").rlike(r"^\s{2,}-\s+")})
    w = _to_here(key)
    lines = lines.withColumns({
        "section": F.coalesce(F.last(F.when(F.col("is_section"), T.strip(F.regexp_replace("bare", "^#{2,3} ", ""))), ignorenulls=True).over(w), F.lit("")),
        "part": F.sum(F.when(F.col("is_section") | F.col("is_top"), 1).otherwise(0)).over(w)})
    lines = lines.where(~F.col("is_section") & ~F.col("bare").startswith("|"))
    lines = lines.withColumns({"link": T.first_url(F.col("bare"))})
    own = F.max(F.when(F.col("is_top"), F.col("link")))
    link_line = ~F.col("is_top") & (F.col("link") != "") & has_any(F.col("bare"), LINK_TAGS)
    snippet_line = ~F.col("is_top") & has_any(F.col("bare"), SNIPPET_TAGS)
    snippets = F.sort_array(F.collect_list(F.when(snippet_line, F.struct("ord", F.regexp_replace("bare", r"^[-*]\s*", "").alias("text")))))
    cases = lines.groupBy(key, "section", "part").agg(
        F.min(F.when(F.col("is_top"), F.col("ord"))).alias("pos"), F.max(F.when(F.col("is_top"), F.col("bare"))).alias("head"),
        own.alias("own"), F.min(F.when(link_line, F.struct("ord", "link"))).alias("later"), snippets.alias("snippets"))
    cases = cases.where("pos is not null").withColumns({
        "title": T.clean_case_title(F.col("head")),
        "url": F.when(F.col("own") != "", F.col("own")).otherwise(F.coalesce("later.link", F.lit(""))),
        "used": F.when(F.col("own") == "", F.col("later.ord"))})
    detail = F.lit(False)
    for prefix in DETAIL_PREFIXES:
        detail = detail | F.col("title").startswith(prefix)
    free = F.filter("snippets", lambda s: F.col("used").isNull() | (s["ord"] != F.col("used")))
    return cases.where(
        ~detail & (F.col("title") != "") & (F.col("url") != "") & ~F.lower("section").startswith("platform statistics")
    ).select(key, "pos", "title", "url", "section", F.coalesce(F.try_element_at(free, F.lit(1))["text"], F.lit("")).alias("snippet"))
