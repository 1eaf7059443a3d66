"""Landed web pages to items: a small tag reader per page, then relational steps over node rows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import text as T
from briefwright.lexicon import let
from briefwright.operators.joins import nearest_position
from briefwright.operators.ranking import first_per
from briefwright.schema import to_items
from briefwright.sources.payloads import award_items

# Elements without end tag, and elements that end an open paragraph.
VOID = {"br", "img", "meta", "link", "input", "hr", "source", "area", "base", "col", "embed", "wbr"}
BLOCK = {"p", "div", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table", "pre", "main", "nav", "footer"}


class _Nodes(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []

    def _add(self, tag: str, attrs: dict[str, str | None]) -> int:
        self.rows.append({
            "ord": len(self.rows), "parent": self.open[-1] if self.open else -1, "path": list(self.open), "tag": tag,
            "id": attrs.get("id") or "", "cls": attrs.get("class") or "", "href": attrs.get("href") or "", "bits": []})
        return len(self.rows) - 1

    def _close(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]]["tag"] == tag:
                del self.open[depth:]
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK and self.open and self.rows[self.open[-1]]["tag"] == "p":
            self._close("p")
        if tag == "li" and self.open and self.rows[self.open[-1]]["tag"] == "li":
            self._close("li")
        node = self._add(tag, dict(attrs))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._add(tag, dict(attrs))

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if text:
            node = self._add("#text", {})
            for owner in [*self.open, node]:
                self.rows[owner]["bits"].append(text)


NODE_DDL = "ord INT, parent INT, path ARRAY<INT>, tag STRING, id STRING, cls STRING, href STRING, text STRING"
_NODE_TYPES = {"ord": pa.int32(), "parent": pa.int32(), "path": pa.list_(pa.int32()), "tag": pa.string(), "id": pa.string(), "cls": pa.string(),
               "href": pa.string(), "text": pa.string()}
#: Nodes, and characters of their text, that one Arrow batch holds at most, but for the last page in it.
BATCH_NODES, BATCH_CHARS = 20_000, 4_000_000


def page_nodes(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per element and text piece of a page, in document order: place, parent, ancestors, tag, id,
    class, link and the stripped text below it. The nodes of many pages go out in one batch of bounded size."""
    key_type = dict(pages.dtypes)[key]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners, nodes, chars = batch.column(0), [], [], 0

            def out() -> pa.RecordBatch:
                columns = [pa.array([n[c] for n in nodes], kind) for c, kind in _NODE_TYPES.items()]
                return pa.RecordBatch.from_arrays([keys.take(pa.array(owners, pa.int64())), *columns], [key, *_NODE_TYPES])

            for owner, source in enumerate(batch.column(1)):
                parser = _Nodes()
                parser.feed(source.as_py() or "")
                parser.close()
                for node in parser.rows:
                    node["text"] = "".join(node.pop("bits"))
                    chars += len(node["text"])
                nodes += parser.rows
                owners += [owner] * len(parser.rows)
                if len(nodes) >= BATCH_NODES or chars >= BATCH_CHARS:
                    yield out()
                    owners, nodes, chars = [], [], 0
            if nodes:
                yield out()

    return pages.select(key, html).mapInArrow(read, f"`{key}` {key_type}, {NODE_DDL}")


def _to_here(key: str) -> Window:
    return Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)


def _clean_award(heading: Column) -> Column:
    return F.trim(F.regexp_replace(heading, r"\s*Awards?\s*$", ""))


def award_page_sections(pages: DataFrame) -> DataFrame:
    """Award page with one section per year (page_id, conf, year, html, ingest_ts): category headings, then
    paragraphs with a bold title. Authors follow a line break, or the title, or stand in the next paragraph."""
    key = "page_id"
    nodes = page_nodes(pages, key).join(pages.select(key, "conf", "year", "ingest_ts"), key)
    strong = nodes.where("tag = 'strong'").groupBy(key, F.col("parent").alias("p_ord")).agg(
        F.min(F.struct("ord", "text")).alias("s")).select(key, "p_ord", F.col("s.ord").alias("s_ord"), F.col("s.text").alias("s_text"))
    bold_below = nodes.where("tag = 'strong'").select(key, F.explode("path").alias("p_ord")).distinct().withColumn("has_bold", F.lit(True))
    top = nodes.where("tag in ('h3', 'h4', 'h5', 'p')").join(strong, (nodes[key] == strong[key]) & (nodes["ord"] == strong["p_ord"]), "left").select(
        nodes["*"], "s_ord", "s_text")
    top = top.join(bold_below.withColumnRenamed("p_ord", "ord"), [key, "ord"], "left")
    w = _to_here(key)
    is_year_line = (F.col("tag") == "h3") | ((F.col("tag") == "p") & F.coalesce(F.col("s_text").rlike(r"^\d{4}$"), F.lit(False)))
    marker = F.when(F.col("tag") == "h3", F.col("text")).otherwise(F.col("s_text"))
    top = top.withColumns({
        "mark": F.when(is_year_line, marker), "is_mark": is_year_line,
        "is_head": F.col("tag").isin("h4", "h5")})
    top = top.withColumns({
        "in_year": F.last("mark", ignorenulls=True).over(w) == F.col("year").cast("string"),
        "head": F.last(F.when(F.col("is_head"), F.struct("ord", "text")), ignorenulls=True).over(w),
        "mark_ord": F.last(F.when(F.col("is_mark"), F.col("ord")), ignorenulls=True).over(w),
        "next_tag": F.lead(F.when(F.col("tag") == "p", F.struct("text", F.coalesce("has_bold", F.lit(False)).alias("bold")))).over(
            Window.partitionBy(key).orderBy("ord"))})
    papers = top.where("in_year and not is_mark and tag = 'p' and coalesce(s_text, '') <> ''")
    # pieces of the title paragraph after the bold title
    pieces = nodes.select(F.col(key).alias("k"), F.col("parent").alias("q"), F.col("ord").alias("c_ord"), F.col("tag").alias("c_tag"), F.col("text").alias("c_text"))
    joined = papers.join(pieces, (papers[key] == pieces["k"]) & (papers["ord"] == pieces["q"]) & (pieces["c_ord"] > papers["s_ord"]), "left")
    listed = joined.groupBy(papers[key], papers["ord"]).agg(F.sort_array(F.collect_list(F.struct("c_ord", "c_tag", "c_text"))).alias("after"))
    papers = papers.join(listed, [key, "ord"])
    br = F.try_element_at(F.filter("after", lambda x: x["c_tag"] == "br"), F.lit(1))["c_ord"]
    after_br = F.array_join(F.transform(F.filter("after", lambda x: (x["c_ord"] > br) & (x["c_text"] != "")), lambda x: x["c_text"]), " ")
    follows = F.try_element_at("after", F.lit(1))
    direct = F.when(follows["c_tag"] == "#text", follows["c_text"])
    below = F.when(~F.col("next_tag.bold"), F.col("next_tag.text"))
    author = F.coalesce(F.nullif(F.when(br.isNotNull(), after_br), F.lit("")), F.nullif(direct, F.lit("")), below, F.lit(""))
    award = F.when(F.col("head.ord") > F.col("mark_ord"), F.regexp_replace(_clean_award(F.regexp_replace("head.text", r"AAAI-\d+\s*", "")), r"\s*–\s*", " - "))
    return award_items(papers.withColumns({
        "paper_title": F.col("s_text"), "author": author, "award": F.coalesce(F.nullif(F.trim(award), F.lit("")), F.lit("Outstanding Paper")), "url": F.lit("")}))


def award_page_lines(pages: DataFrame) -> DataFrame:
    """Award page of paragraph triples below a "Best Papers" heading: award type, ``Paper Name:``, ``Authors:``."""
    key = "page_id"
    nodes = page_nodes(pages, key).where("tag in ('h1', 'h2', 'p')").join(pages.select(key, "conf", "year", "url", "ingest_ts"), key)
    w = _to_here(key)
    before = Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    head = F.col("tag").isin("h1", "h2")
    start = F.min(F.when((F.col("tag") == "h2") & F.col("text").contains("Best Papers"), F.col("ord"))).over(Window.partitionBy(key))
    rows = nodes.withColumn("start", start).where("ord >= start")
    rows = rows.withColumn("closed", F.max(F.when(head & (F.col("ord") > F.col("start")), 1).otherwise(0)).over(w)).where("closed = 0 and tag = 'p' and text <> ''")
    text = F.col("text")
    is_award = text.rlike(r"(?i)^(Best [\w\s]+|Honorable Mention)[:\s]*") & ~text.contains("Paper Name") & ~text.contains("Authors")
    is_name, is_author = ~is_award & text.startswith("Paper Name:"), ~is_award & text.startswith("Authors:")
    award = F.trim(F.regexp_replace(text, r"\s*:?\s*(ID:\s*\d+)?\s*$", ""))
    named = F.last(F.when(is_name, F.struct(F.trim(F.substr(text, F.lit(12))).alias("t"), F.lit(False).alias("used")))
                   .when(is_author, F.struct(F.lit("").alias("t"), F.lit(True).alias("used"))), ignorenulls=True).over(before)
    rows = rows.withColumns({"award": F.coalesce(F.last(F.when(is_award, award), ignorenulls=True).over(w), F.lit("Best Paper")),
                             "named": named, "is_author": is_author})
    papers = rows.where("is_author and named.t <> ''")
    return award_items(papers.withColumns({"paper_title": F.col("named.t"), "author": F.trim(F.substr("text", F.lit(9)))}))


def award_page_list(pages: DataFrame) -> DataFrame:
    """Award page of ``h2`` categories with lists: bold title, emphasised authors, semicolons to commas."""
    key = "page_id"
    nodes = page_nodes(pages, key).join(pages.select(key, "conf", "year", "url", "ingest_ts"), key)
    w = _to_here(key)
    nodes = nodes.withColumns({
        "award": F.coalesce(F.last(F.when(F.col("tag") == "h2", _clean_award(F.col("text"))), ignorenulls=True).over(w), F.lit("Best Paper")),
        "li": F.last(F.when(F.col("tag") == "li", F.col("ord")), ignorenulls=True).over(w)})
    inside = nodes.where(F.col("tag").isin("strong", "em") & F.exists("path", lambda a: a == F.col("li")))
    entries = inside.groupBy(key, "li", "conf", "year", "url", "ingest_ts", "award").agg(
        F.min(F.when(F.col("tag") == "strong", F.struct("ord", "text"))).alias("t"), F.min(F.when(F.col("tag") == "em", F.struct("ord", "text"))).alias("a"))
    author = T.text_or_empty(F.col("a.text"))
    commas = F.array_join(F.filter(F.transform(F.split(author, ";"), lambda x: F.trim(x)), lambda x: x != ""), ", ")
    return award_items(entries.where("coalesce(t.text, '') <> ''").withColumns({
        "paper_title": F.rtrim("t.text", F.lit('"')), "author": F.when(author.contains(";"), commas).otherwise(author)}))


LISTING_HOST = "https://papers.cool"


def paper_listing(pages: DataFrame) -> DataFrame:
    """Listing pages (page_id, category, html, ingest_ts): papers with rank and arXiv id; the first page wins per id."""
    key = "page_id"
    nodes = page_nodes(pages, key).join(pages.select(key, "category", "ingest_ts"), key)
    w = _to_here(key)
    has = lambda c: F.array_contains(F.split("cls", r"\s+"), c)
    nodes = nodes.withColumn("paper", F.last(F.when((F.col("tag") == "div") & has("paper"), F.struct("ord", "id")), ignorenulls=True).over(w))
    inside = nodes.where(F.exists("path", lambda a: a == F.col("paper.ord")))
    first = lambda cond: F.min(F.when(cond, F.struct("ord", "text", "href")))
    rows = inside.groupBy(key, "category", "ingest_ts", F.col("paper.ord").alias("place"), F.col("paper.id").alias("pid")).agg(
        first((F.col("tag") == "a") & has("title-link")).alias("a"), first((F.col("tag") == "span") & has("index")).alias("i")).where("a is not null")
    rank = F.coalesce(F.ltrim("i.text", F.lit("#")).try_cast("int"), F.lit(0))
    href = F.col("a.href")
    staged = rows.withColumns({
        "title": F.col("a.text"), "url": F.when(href.startswith("/"), F.concat(F.lit(LISTING_HOST), href)).otherwise(href),
        "arxiv_id": T.arxiv_id_in(F.when(F.col("pid") != "", F.col("pid")).otherwise(href)),
        "score": F.when(rank > 0, F.greatest(F.lit(0.0), F.lit(100.0) - rank)).otherwise(0.0), "source": F.lit("coolpaper"),
        "source_type": F.lit("http_scrape"), "published_at": F.col("ingest_ts"), "collected_at": F.col("ingest_ts"),
        "tags": F.array(F.lit("paper"), "category")})
    return to_items(first_per(staged.where("arxiv_id is not null"), ["arxiv_id"], [F.col(key), F.col("place")]))


# Marks of the embedded payload. The repeated parts are possessive or single characters, as the
# JVM matches a repeated choice by recursion and would run out of stack on a long text.
CHUNK_PATTERN = r'(?s)self\.__next_f\.push\(\[1,"(.*?(?<!\\)(?:\\\\)*)"\]\)'
QUOTED = r'"((?:[^"\\]++|\\.)*+)"'
SLUG_PATTERN = r'"slug"\s*:\s*\{\s*"_type"\s*:\s*"slug"\s*,\s*"current"\s*:\s*' + QUOTED
TITLE_PATTERN = r'"title"\s*:\s*' + QUOTED
PUBLISHED_PATTERN = r'"publishedOn"\s*:\s*' + QUOTED


def payload_text(html: Column) -> Column:
    """Embedded script chunks of a page, unescaped and joined."""
    chunks = F.regexp_extract_all(html, F.lit(CHUNK_PATTERN), F.lit(1))
    plain = F.transform(chunks, lambda c: F.coalesce(F.get_json_object(F.concat(F.lit('{"v":"'), c, F.lit('"}')), "$.v"), c))
    return F.array_join(plain, "")


def pattern_positions(df: DataFrame, keys: list[str], text: str, pattern: str) -> DataFrame:
    """(keys, pos, value) of every match, value is the first group."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("value"),
        # matches and the texts between them give the positions
        F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.length).alias("whole"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"))

    def placed(m: Column) -> Column:
        start = lambda i: F.aggregate(F.sequence(F.lit(0), i), F.lit(0), lambda acc, k: acc + F.get(m["gap"], k)
                                      + F.when(k < i, F.get(m["whole"], k)).otherwise(0))
        return F.transform(m["value"], lambda v, i: F.struct(start(i).cast("bigint").alias("pos"), v.alias("value")))

    return df.select(*keys, F.explode(let(found, placed)).alias("m")).select(*keys, "m.*")


def script_payload_items(pages: DataFrame, source: str = "anthropic", author: str = "Anthropic", base: str = "https://www.anthropic.com",
                         window: int = 2000) -> DataFrame:
    """Pages with an embedded payload (page_id, section, html, ingest_ts): every slug with the nearest title and
    date at most ``window`` characters away; slugs without title are dropped, first slug wins."""
    texts = pages.select("page_id", "section", "ingest_ts", payload_text(F.col("html")).alias("text"))
    key = ["page_id"]
    slugs = pattern_positions(texts, [*key, "section", "ingest_ts"], "text", SLUG_PATTERN).withColumnRenamed("value", "slug")
    titled = nearest_position(slugs, pattern_positions(texts, key, "text", TITLE_PATTERN), "page_id", window).withColumnRenamed("value", "title")
    dated = nearest_position(titled.where("title is not null"), pattern_positions(texts, key, "text", PUBLISHED_PATTERN), "page_id", window).withColumnRenamed("value", "day")
    first = first_per(dated, ["slug"], [F.col("page_id"), F.col("pos")])
    return to_items(first.withColumns({
        "source": F.lit(source), "source_type": F.lit("http_scrape"), "url": F.concat_ws("/", F.lit(base), "section", "slug"), "author": F.lit(author),
        "published_at": T.published_at([F.nullif("day", F.lit("null"))], F.col("ingest_ts")), "collected_at": F.col("ingest_ts"), "score": F.lit(0.0),
        "tags": F.array("section", F.lit("blog"))}))
