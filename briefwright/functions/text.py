"""Text columns: tokens, titles, keywords, numbers, dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from briefwright.lexicon import Lexicon, TermFinder, any_substring, constant, let, substring_hits, term_array

EMPTY = F.lit  # readability: EMPTY("") is the empty string


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def content_hash(url: Column, source: Column, title: Column) -> Column:
    key = F.when(text_or_empty(url) != "", url).otherwise(
        F.concat(text_or_empty(source), F.lit(":"), text_or_empty(title)))
    return F.sha2(key, 256)


def arxiv_id_in(text: Column) -> Column:
    """First arXiv-like id, version stripped; null when there is none."""
    return F.nullif(F.regexp_extract(text_or_empty(text), r"(\d{4}\.\d{4,5})(?:v\d+)?", 1), F.lit(""))


def slug(value: Column, joiner: str = "_") -> Column:
    return F.btrim(F.regexp_replace(F.lower(text_or_empty(value)), "[^a-z0-9]+", joiner), F.lit(joiner))


def strip(text: Column) -> Column:
    """White space of any kind removed from both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Whitespace runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(text_or_empty(text), r"(?U)\s+", " "))


def clean_title(title: Column) -> Column:
    return squeeze(F.regexp_replace(text_or_empty(title), r"https?://\S+", " "))


def trim_text(text: Column, n: int) -> Column:
    return F.substring(squeeze(text), 1, n)


def compact_inline(text: Column, n: int | None = None) -> Column:
    """One line; longer than n characters ends in an ellipsis."""
    line = squeeze(text)
    if n is None:
        return line
    return F.when(F.length(line) > n, F.concat(F.rtrim(F.substring(line, 1, n - 1)), F.lit("…"))).otherwise(line)


def normalise_title(title: Column) -> Column:
    plain = F.regexp_replace(trim_text(title, 200), r"https?://\S+", "")
    return F.lower(F.trim(F.regexp_replace(plain, "[`*_>#]", "")))


def normalise_point(line: Column) -> Column:
    out = F.regexp_replace(F.trim(line), r"^[-*]\s+", "")
    out = F.regexp_replace(out, r"^\d+\.\s*", "")
    out = F.regexp_replace(out, r"https?://\S+", "")
    return F.lower(squeeze(F.regexp_replace(out, r"[`*_>#\[\]]", "")))


def item_text(source: Column, title: Column, content: Column, tags: Column, author: Column) -> Column:
    """Lower-case text used for clustering and scoring."""
    return F.lower(F.concat_ws(
        " ", text_or_empty(title), text_or_empty(content), F.array_join(F.coalesce(tags, term_array([])), " "),
        text_or_empty(author), text_or_empty(source)))


def eval_text(title: Column, content: Column, author: Column, tags: Column, url: Column) -> Column:
    """Lower-case text of the audit labels: also holds the url, not the source."""
    return F.lower(F.concat_ws(
        " ", text_or_empty(title), text_or_empty(content), text_or_empty(author),
        F.array_join(F.coalesce(tags, term_array([])), " "), text_or_empty(url)))


def extra_strings(extra: Column) -> Column:
    """The string values of the extra object (numbers and nested values are left out)."""
    fields = F.map_values(F.try_variant_get(F.try_parse_json(extra), "$", "map<string, variant>"))
    strings = F.transform(fields, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return F.coalesce(F.array_compact(strings), term_array([]))


def search_text(source: Column, title: Column, content: Column, tags: Column, author: Column, extra: Column) -> Column:
    """Lower-case text used for routing: non-empty parts, tags and string extras."""
    parts = F.concat(
        F.array(text_or_empty(title), text_or_empty(content), text_or_empty(author), text_or_empty(source)),
        F.coalesce(tags, term_array([])), extra_strings(extra))
    return F.lower(F.array_join(F.filter(parts, lambda p: p != ""), " "))


TOKEN_PATTERN = r"([a-zA-Z][a-zA-Z0-9_+.-]{2,}|[一-鿿]{2,})"


def tokens(text: Column, stopwords: Iterable[str]) -> Column:
    """Distinct Latin words and CJK runs of three or more characters, in order of first appearance."""
    words = F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(TOKEN_PATTERN), F.lit(1))
    kept = F.array_except(words, term_array(stopwords))  # by hash, and in order
    bare = F.transform(kept, lambda w: F.btrim(w, F.lit("._-")))
    return F.array_distinct(F.filter(bare, lambda w: F.length(w) >= 3))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(F.array_union(a, b)))


def compact(text: Column) -> Column:
    """Lower case without spaces and light punctuation."""
    return F.regexp_replace(F.lower(text_or_empty(text)), "(?U)[\\s_\\-:：/·.'\"“”‘’「」]+", "")


def _compact_term(term: str) -> str:
    return "".join(ch for ch in term.lower() if not ch.isspace() and ch not in "_-:：/·.'\"“”‘’「」")


def phrase_hits(text: Column, compacted: Column, phrases: Iterable[str]) -> Column:
    """Distinct phrases found in the text or, spaces and punctuation dropped, in its compact form."""
    pairs = constant([{"p": p.lower(), "c": _compact_term(p)} for p in phrases], "array<struct<p:string,c:string>>")
    both = F.struct(text.alias("t"), compacted.alias("d"))
    return let(both, lambda b: F.size(F.filter(pairs, lambda x: b["t"].contains(x["p"]) | b["d"].contains(x["c"]))))


# Phrases that anchor the alternative-route theme, and the two negated next-token patterns.
ROUTE_ANCHORS = [
    "flow matching", "non-autoregressive", "non autoregressive", "continual learning", "continuous learning",
    "continue learning", "lifelong learning", "online learning", "test-time learning", "test time learning",
    "test-time adaptation", "test time adaptation", "self-improvement", "self improvement", "self-improving",
    "self improving", "beyond scaling", "beyond scale", "scaling alternative", "alternatives to scaling",
]
NEGATED_NEXT_TOKEN = (
    r"(?U)\b(?:not|without|beyond|abandon(?:ing)?|abandons?|drop(?:ping)?|drops?|do(?:es)?\s+not|doesn't|don't)\b"
    r"\s+(?:\w+\s+){0,4}(?:predict(?:ing)?\s+(?:the\s+)?next[-\s]?token|next[-\s]?token\s+prediction)\b"
)
NEGATED_NEXT_TOKEN_CJK = r"(?iu)(?:放弃|不再|不是|并非|无需).{0,12}预测.{0,4}下一个\s*token"


def route_signal(text: Column, lexicon: Lexicon) -> Column:
    """The text is about an alternative to the mainstream scaling route. All phrases are looked up in one pass over the text on one line
    and over its compact form; only texts that this leaves open are read for context and negations. ``text`` should be a column, not
    an expression: it is read several times."""
    strong, phrase, anchor = (list(dict.fromkeys(p.lower() for p in g)) for g in (lexicon["route_strong"], lexicon["route_phrase"], ROUTE_ANCHORS))
    forms: dict[str, list[str]] = {}
    for p in [*strong, *phrase, *anchor]:
        forms.setdefault(_compact_term(p), []).append(p)
    finder = TermFinder([*strong, *phrase, *anchor], forms)
    low = F.lower(text_or_empty(text))
    found = finder.hits_in_line(low)
    flat = F.regexp_replace(low, r"(?U)\s+", " ")
    anchored = (finder.count(found, phrase) >= 2) & (finder.count(found, anchor) > 0)
    # what the patterns cannot do without is looked for first
    negated = (low.contains("predict") & low.contains("token") & flat.rlike(NEGATED_NEXT_TOKEN)) | (
        low.contains("预测") & low.contains("下一个") & flat.rlike(NEGATED_NEXT_TOKEN_CJK))
    context = any_substring(flat, [t for t in lexicon["route_context"] if t])
    return (finder.count(found, strong) > 0) | ((anchored | negated) & context)


def says_unrelated(text: Column) -> Column:
    return text.rlike(r"(?U)\b(unrelated|not\s+related|separate\s+from)\b")


# Money, percentage and power figures.
MONEY_PATTERN = (
    r"(?iu)(?:[$€£¥]\s?\d+(?:\.\d+)?\s?(?:b|bn|billion|m|mn|million|t|trillion)?)"
    r"|(?:\b\d+(?:\.\d+)?\s?(?:billion|million|trillion|bn|mn|%|x)\b)"
)
POWER_PATTERN = r"(?iu)\b\d+(?:\.\d+)?\s?(?:gw|gigawatt|mw|megawatt)\b"

VERSION_PATTERN = r"(?<![a-zA-Z0-9])v?(\d+)\.(\d+)(?:\.(\d+))?(?:[-+.]?([0-9A-Za-z][0-9A-Za-z.-]*))?"
PRERELEASE_PATTERN = r"(?i)(?:^|[-.])(alpha|beta|rc|pre|preview|dev|nightly|canary)\d*"


def release_kind(source: Column, title: Column, url: Column) -> Column:
    """Size of a release post: prerelease, major, patch, minor or unknown; null for other rows."""
    from briefwright.functions.urls import is_release_post

    text = F.lower(F.concat_ws(" ", text_or_empty(title), text_or_empty(url)))
    group = lambda i: F.regexp_extract(text, VERSION_PATTERN, i)
    number = lambda i: F.coalesce(F.nullif(group(i), F.lit("")), F.lit("0")).cast("decimal(38,0)")
    suffix = group(4)
    kind = (
        F.when(~text.rlike(VERSION_PATTERN), "unknown")
        .when((suffix != "") & F.concat(F.lit("-"), suffix).rlike(PRERELEASE_PATTERN), "prerelease")
        .when((number(1) >= 1) & (number(2) == 0) & (number(3) == 0), "major")
        .when(number(3) > 0, "patch")
        .when(number(2) > 0, "minor")
        .otherwise("unknown")
    )
    return F.when((source == "github") & is_release_post(title, url), kind)


KEYWORD_PATTERN = r"([A-Za-z][A-Za-z0-9.+-]{2,}|[一-鿿]{2,})"


def keywords(text: Column, lexicon: Lexicon) -> Column:
    """Keywords of a text, repetitions kept: stop words, links, dotted tokens and letter-digit codes dropped. Stop words are sets, not
    arrays, which would be gone through for every word."""
    latin_stop = [*lexicon["keyword_stop_latin"], *lexicon["keyword_generic"]]
    cjk_stop = lexicon["keyword_stop_cjk"]
    found = F.regexp_extract_all(text_or_empty(text), F.lit(KEYWORD_PATTERN), F.lit(1))

    def keep(word: Column) -> Column:
        low = F.lower(word)
        return ~(
            low.isin(*latin_stop) | word.isin(*cjk_stop)
            | low.startswith("http") | low.startswith("www") | word.contains(".")
            | word.rlike(r"^[A-Za-z]\d+$")
        )

    return F.filter(found, keep)


def report_keywords(text: Column, lexicon: Lexicon) -> Column:
    """Keywords of report cases: same tokens, the report stop list, letter case ignored."""
    stop = [term.lower() for term in lexicon["report_stop"]]
    found = F.regexp_extract_all(text_or_empty(text), F.lit(KEYWORD_PATTERN), F.lit(1))
    return F.filter(found, lambda word: ~F.lower(word).isin(*stop))


# Alias pattern -> canonical entity name, in order of precedence.
ENTITY_ALIASES = [
    (r"chatgpt", "ChatGPT"), (r"gpt[- ]?5\.5", "GPT-5.5"), (r"workspace agents?", "Workspace Agents"),
    (r"claude code", "Claude Code"), (r"claude design", "Claude Design"), (r"claude opus\s*4\.7", "Claude Opus 4.7"),
    (r"claude opus", "Claude Opus"), (r"managed agents?", "Managed Agents"), (r"codex", "Codex"),
    (r"ollama", "Ollama"), (r"autogpt", "AutoGPT"), (r"open[- ]webui", "Open-WebUI"),
    (r"deepseek[- ]?v?4", "DeepSeek-V4"), (r"gemini", "Gemini"), (r"gemma\s*4", "Gemma 4"), (r"gemma", "Gemma"),
    (r"qwen\s*3\.5", "Qwen 3.5"), (r"qwen", "Qwen"), (r"langchain", "LangChain"), (r"langflow", "Langflow"),
    (r"transformers?", "Transformers"), (r"kimi\s*cli", "Kimi CLI"), (r"project glasswing", "Project Glasswing"),
    (r"freecodecamp", "freeCodeCamp"), (r"developer-roadmap|roadmap\.sh", "developer-roadmap"),
    (r"awesome-selfhosted", "awesome-selfhosted"),
]
PHRASE_PATTERN = (
    r"((?:[A-Z][A-Za-z0-9.+-]{1,}|[A-Z]{2,}[A-Za-z0-9.+-]*)(?:\s+(?:[A-Z][A-Za-z0-9.+-]{1,}|"
    r"[A-Z]{2,}[A-Za-z0-9.+-]*|Code|Design|CLI|SDK|API|Agents?|Desktop|Studio)){0,2})"
)


def distinct_ignoring_case(values: Column) -> Column:
    """First spelling of every value, compared in lower case, order kept."""
    def first_only(both: Column) -> Column:
        return F.filter(both["v"], lambda v, i: F.array_position(both["low"], F.lower(v)) == i + 1)

    return let(values, lambda v: let(F.struct(v.alias("v"), F.transform(v, F.lower).alias("low")), first_only))


def entity_names(text: Column, lexicon: Lexicon) -> Column:
    """Canonical names of known aliases, then capitalised phrases of up to three words."""
    plain = F.translate(text_or_empty(text), "–—", "--")
    low = F.lower(plain)
    known = F.array_compact(F.array(*[F.when(low.rlike(pattern), name) for pattern, name in ENTITY_ALIASES]))
    latin_stop = term_array([*lexicon["keyword_stop_latin"], *lexicon["keyword_generic"]])
    stop = term_array(lexicon["entity_stop"])
    phrases = F.transform(
        F.regexp_extract_all(plain, F.lit(PHRASE_PATTERN), F.lit(1)),
        lambda p: F.btrim(F.regexp_replace(p, r"\s+", " "), F.lit(" -")))

    def keep(phrase: Column) -> Column:
        lowered = F.lower(phrase)
        return ~(F.array_contains(latin_stop, lowered) | F.array_contains(stop, phrase)
                 | lowered.startswith("http") | lowered.startswith("www") | lowered.startswith("t.co")
                 ) & (F.length(phrase) >= 3)

    return distinct_ignoring_case(F.concat(known, F.filter(phrases, keep)))


def heat_score(detail: Column) -> Column:
    """Number before the heat word; ten thousands when the text says so."""
    number = F.regexp_extract(text_or_empty(detail), r"(\d+(?:\.\d+)?)\s*万?\s*热度", 1)
    value = F.when(number != "", number.cast("double")).otherwise(0.0)
    return F.when(text_or_empty(detail).contains("万"), value * 10000).otherwise(value)


def duration_seconds(duration: Column) -> Column:
    """HH:MM:SS, MM:SS or plain seconds; anything else is 0."""
    text = F.trim(text_or_empty(duration))
    parts = F.split(text, ":")
    n = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("bigint")
    value = (
        F.when(text.rlike(r"^\d+$"), text.try_cast("bigint"))
        .when(F.size(parts) == 3, n(1) * 3600 + n(2) * 60 + n(3))
        .when(F.size(parts) == 2, n(1) * 60 + n(2))
    )
    return F.coalesce(value, F.lit(0).cast("bigint"))


URL_PATTERN = r"(https?://[^\s　)）\]】,，;；]+)"


def all_urls(text: Column) -> Column:
    """Distinct URLs in order, trailing punctuation (also CJK) dropped."""
    found = F.regexp_extract_all(text_or_empty(text), F.lit(URL_PATTERN), F.lit(1))
    bare = F.transform(found, lambda u: F.rtrim(u, F.lit("),.，。;；]）")))
    return F.array_distinct(F.filter(bare, lambda u: u != ""))


def first_url(text: Column) -> Column:
    return F.coalesce(F.try_element_at(all_urls(text), F.lit(1)), F.lit(""))


def clean_case_title(text: Column) -> Column:
    """Title of a report case: list marks, Markdown links, URLs and source suffixes removed."""
    out = F.regexp_replace(F.trim(text), r"^[-*]\s+", "")
    out = F.regexp_replace(out, r"^\d+\.\s*", "")
    out = F.regexp_replace(out, r"\[([^\]]+)\]\((https?://[^)]+)\)", "$1")
    out = F.regexp_replace(out, r"https?://\S+", "")
    out = F.replace(F.replace(out, F.lit("**"), F.lit("")), F.lit("`"), F.lit(""))
    out = F.regexp_replace(out, r"^高亮[:：]?\s*", "")
    out = F.regexp_replace(out, r"(?i)(原文|链接|讨论|详情|技术报告|Link|更多信息)[:：].*$", "")
    out = F.regexp_replace(out, r"(?i)(—\s*Link|。链接|链接)$", "")
    out = F.regexp_replace(out, r"（[^（）]{1,20}）$", "")
    out = F.regexp_replace(out, r"\([^()]{1,20}\)$", "")
    return F.btrim(F.regexp_replace(out, r"\s+", " "), F.lit(" -：:;；，。,"))


def number_or_zero(value: Column, kind: str = "double") -> Column:
    return F.coalesce(value.try_cast(kind), F.lit(0).cast(kind))


def extra_number(extra: Column, names: Iterable[str]) -> Column:
    """First alias that is present decides; a value that is no number counts as 0."""
    parsed = F.try_parse_json(extra)
    present = F.when(F.lit(False), F.lit(0.0))
    for name in names:
        found = F.try_variant_get(parsed, f"$.{name}", "variant")
        present = present.when(found.isNotNull(), F.coalesce(F.try_variant_get(parsed, f"$.{name}", "double"), F.lit(0.0)))
    return present.otherwise(0.0)


def epoch_or_iso_ms(value: Column) -> Column:
    """Seconds, milliseconds or ISO text to milliseconds; null when unreadable."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    iso = F.unix_millis(F.try_to_timestamp(text))
    return F.when(number < 1e10, F.floor(number * 1000)).when(number.isNotNull(), F.floor(number)).otherwise(iso)


def published_at(candidates: Iterable[Column], fallback: Column) -> Column:
    """First readable date of the candidates (ISO, RSS or social form), else the ingest time."""
    readable = []
    for raw in candidates:
        text = F.nullif(F.trim(raw.cast("string")), F.lit(""))
        no_weekday = F.regexp_replace(text, r"^[A-Za-z]{3,9},\s*", "")
        no_zone_name = F.regexp_replace(no_weekday, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
        social = F.regexp_replace(text, r"^[A-Za-z]{3}\s+([A-Za-z]{3})\s+(\d{1,2})\s+([\d:]{8})\s+([+-]\d{4})\s+(\d{4})$", "$2 $1 $5 $3 $4")
        readable += [
            F.try_to_timestamp(text),
            F.try_to_timestamp(no_zone_name, F.lit("d MMM yyyy HH:mm:ss Z")),
            F.try_to_timestamp(social, F.lit("d MMM yyyy HH:mm:ss Z")),
            F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm:ss")),
            F.try_to_timestamp(text, F.lit("MMMM d, yyyy")),
        ]
    return F.coalesce(*readable, fallback)


def metric_text(value: Column) -> Column:
    """A number with separators and 0, 1 or up to 3 decimals by size."""
    small = F.regexp_replace(F.regexp_replace(F.format_number(value, 3), "0+$", ""), r"\.$", "")
    return F.when(value >= 100, F.format_number(value, 0)).when(value >= 10, F.format_number(value, 1)).otherwise(small)
