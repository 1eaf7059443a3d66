"""Word lists pinned against an expectation of their own, and rules that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from briefwright.lexicon import Lexicon
from briefwright.operators import events as E, joins as J, scoring as S


def test_release_words():
    want = "launch launches launched release released introducing available availability ships shipping upgrade upgrading pricing workflow workflows api".split()
    assert [w for w in S.RELEASE_WORDS if " " not in w] == want and {"same price", "fast mode"} <= set(S.RELEASE_WORDS)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 150])
def test_masks_of_any_number_of_terms(spark, n):
    terms = [f"t{i}" for i in range(n)]
    tokens = F.array(*[F.lit(t) for t in terms[::2]]) if n else F.array().cast("array<string>")
    rows = spark.range(2).select(S._mask(terms, tokens).alias("m"))
    assert [r.k for r in rows.select(S.mask_count("m").alias("k")).collect()] == [len(terms[::2])] * 2


def test_union_of_masks_of_a_large_group(spark):
    lexicon = Lexicon().replace(business=[f"t{i}" for i in range(100)])
    rows = spark.createDataFrame([(1, ["t1", "t99"]), (1, ["t99", "t70"]), (2, [])], "event int, tokens array<string>")
    rows = rows.withColumn("m_business", S._mask(lexicon["business"], F.col("tokens")))
    got = rows.groupBy("event").agg(S._union("business", lexicon)).select("event", S.mask_count("m_business").alias("k")).collect()
    assert {r.event: r.k for r in got} == {1: 3, 2: 0}


def test_event_id_has_one_rule_for_any_size_and_order(spark):
    def ids(order):
        rows = [("r", 1, f"https://a.example/{i}", "") for i in order] + [("r", 2, "", "title"), ("r", 3, None, "title")]
        return {r.event: r.event_id for r in E.event_ids(spark.createDataFrame(rows, "_run string, event int, url string, title string")).collect()}

    found = ids(range(1500))
    assert found == ids(range(1499, -1, -1)) and found[2] == found[3] and len(set(found.values())) == 2


def test_rows_without_paper_id_stay_and_spread(spark):
    rows = spark.createDataFrame([(str(i), "2401.00001" if i % 100 == 0 else [None, ""][i % 2]) for i in range(500)], "content_hash string, arxiv_id string")
    seen = spark.createDataFrame([("x", "2401.00001"), ("7", None), ("y", "")], "content_hash string, arxiv_id string")
    assert J.unseen(rows, seen).count() == 500 - 5 - 1


def test_repeated_statistics_have_one_winner(spark):
    items = spark.createDataFrame([("https://www.youtube.com/watch?v=aaaaaaaaaaa", 1.0)], "url string, score double")
    stats = [("aaaaaaaaaaa", 10, 1, 0), ("aaaaaaaaaaa", 20, 4, 0), ("aaaaaaaaaaa", 20, 2, 0)]
    for order in (stats, stats[::-1]):
        table = spark.createDataFrame(order, "video_id string, viewCount int, likeCount int, commentCount int")
        assert J.with_video_stats(items, table).first().score == pytest.approx(4 / 20 * 1e6)
