"""Rows of events, features and title links are computed once, however many steps read them."""

from pyspark.sql import functions as F

from briefwright.functions.ratio import title_ratio
from briefwright.operators import events as E
from briefwright.plans import reports as P

TITLES = ["GPT-5 launch with api pricing", "GPT-5 launch with api prices", "Claude Opus 4.8 release", "vllm throughput benchmark", None, ""]


def counted(df, seen):
    def rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(rows, df.schema)


def items(spark):
    rows = [(k, k, "arxiv" if k % 2 else "openai", TITLES[k % 6], f"https://a.example/{k}", float(k % 5)) for k in range(24)]
    return spark.createDataFrame(rows, "item_id long, pos long, source string, title string, url string, score double").selectExpr(
        "*", "'rss' source_type", "'ann' author", "title content", "timestamp'2026-01-01 00:00:00' published_at", "timestamp'2026-01-01 00:00:00' collected_at",
        "array('AI') tags", "'en' language", "cast(null as string) arxiv_id", "'{}' extra")


def test_features_and_title_links_are_computed_once(spark, monkeypatch):
    read, links, compared = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), E.similar_within
    number = []

    def similar(*args, **kwargs):
        found = compared(*args, **kwargs)
        number.append(found.count())
        return counted(found, links)

    monkeypatch.setattr(E, "similar_within", similar)
    assert E.cluster_members(counted(items(spark), read)).count() == 24
    assert read.value == 24
    assert number[0] > 0 and links.value == number[0]


def test_daily_lines_read_the_events_once(spark):
    read = spark.sparkContext.accumulator(0)
    main = "named_struct('url', concat('https://a.example/', id), 'source', 's', 'tier', 'T1') main"
    events = spark.range(1, 31).selectExpr("'d' _run", "id event", "id event_rank", "cast(id as double) event_score", "concat('topic', id % 3) category", "concat('title ', id) event_title",
                                           "id <= 5 selected", "if(id <= 5, id, null) selection_rank", main)
    members = spark.range(1, 61).selectExpr("'d' _run", "(id + 1) div 2 event", "id % 2 + 1 member_rank", "concat('m', id) title", "'s' source", "'' url")
    lines = P.numbered(P.daily_lines(counted(events, read), members, 10), ["_run"]).orderBy("ord").collect()
    assert read.value == 30
    text = [r.line for r in lines]
    assert text[0] == P.HEADLINES and sum(x.startswith("   - 旁证") for x in text) == 5 and sum(x.startswith("### topic") for x in text) == 3 and sum(x.startswith("- [") for x in text) == 9


def test_ratio_of_repeated_pairs_in_any_order(spark):
    from difflib import SequenceMatcher

    words = ["abcd efgh", "abcd efgx", None, "", "zzz", "abcd efgh"]
    pairs = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in words for b in words)]
    for least in (0.0, 0.85):
        found = spark.createDataFrame(pairs, "i int, a string, b string").coalesce(1).select("i", title_ratio(F.col("a"), F.col("b"), least).alias("r")).orderBy("i").collect()
        for (_, a, b), row in zip(pairs, found, strict=True):
            want = SequenceMatcher(None, a or "", b or "").ratio()
            assert row.r == (want if want >= least else row.r) and (want >= least or row.r < least)
