"""File scans, sinks, streams and selection on written files."""

from pyspark.sql import functions as F

from briefwright.operators.events import _greedy
from briefwright.policy import policy, quota
from briefwright.schema import to_items
from briefwright.sources import feeds, scans, sinks
from briefwright.streaming import streams


def test_snapshot_scan_and_sink(spark, tmp_path):
    for name, titles in (("collected-2026-01-01-0800.json", ["a", "b"]), ("collected-2026-01-02-0800.json", ["c"])):
        (tmp_path / name).write_text("[" + ",".join('{"source": "s", "title": "%s", "url": "u%s", "score": 1}' % (t, t) for t in titles) + "]")
    rows = scans.snapshots(spark, str(tmp_path))
    assert {r.title for r in scans.date_range(rows, "2026-01-01", "2026-01-02").collect()} == {"a", "b", "c"}
    assert [r.title for r in scans.snapshot_lookup(spark, str(tmp_path), "2026-01-02").collect()] == ["c"]
    out = str(tmp_path / "out")
    sinks.write_snapshot(to_items(rows), out, "2026-01-02", "0900")
    assert spark.read.parquet(out).where("run_ts = '0900'").count() == 3


def test_report_corpus_and_usage_log(spark, tmp_path):
    (tmp_path / "digest-2026-01-03-0830.md").write_text("# a\n- b")
    (tmp_path / "digest-2026-02-03-0830.md").write_text("# a")
    assert scans.report_corpus(spark, str(tmp_path), "2026-01-01", "2026-01-31").count() == 1
    (tmp_path / "s.jsonl").write_text('{"timestamp": 1700000000, "message": {"model": "m", "usage": {"input": 5, "cacheRead": 2, "cost": {"input": 0.5, "output": 0.25}}}}\nbroken\n')
    (tmp_path / "s.checkpoint.jsonl").write_text('{"timestamp": 1700000000, "message": {"model": "m", "usage": {"input": 5}}}\n')
    rows = scans.usage_log_scan(spark, str(tmp_path), 1699999999000, 1700000001000).collect()
    assert [(r.model, r.total_tokens, r.cost_usd) for r in rows] == [("m", 7, 0.75)]


def test_feed_file(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>http://x</link><description>S</description></item></channel></rss>")
    rows = feeds.rss_entries(feeds.read_entries(spark, str(tmp_path / "f.xml")), "rss").collect()
    assert [(r.title, r.url, r.content) for r in rows] == [("T", "http://x", "S")]


def test_stream_publishes_each_hash_once(spark, tmp_path):
    schema = "source string,title string,url string,arxiv_id string,published_at timestamp"
    landing, seen = str(tmp_path / "in"), str(tmp_path / "seen")
    day = F.lit("2026-01-01").cast("timestamp")
    spark.createDataFrame([("s", "a", "u1", None), ("s", "b", "u2", "2401.00001"), ("s", "c", "u3", "2401.00001")], "source string,title string,url string,arxiv_id string").withColumn("published_at", day).coalesce(1).write.parquet(landing)
    published = []
    step = streams.publish_batch(seen, lambda df, i: published.extend(r.url for r in df.collect()))
    for _ in range(2):
        query = spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        spark.createDataFrame([("s", "a2", "u1", None), ("s", "d", "u4", None)], "source string,title string,url string,arxiv_id string").withColumn("published_at", day).coalesce(1).write.mode("append").parquet(landing)
    assert sorted(published) == ["u1", "u2", "u4"]


def test_quota_choice():
    import pandas as pd

    rows = [("r", i, i + 1, 100.0 - i, "Social & Community", "", "reddit", False, False) for i in range(6)]
    rows += [("r", 6, 7, 50.0, "Developer Tools", "", "github", False, False), ("r", 7, 8, 40.0, "Research Papers", "c", "arxiv", False, False)]
    names = ["_run", "event", "event_rank", "event_score", "category", "event_campaign", "source_key", "exempt", "secondary_media"]
    got = _greedy(4, quota())(pd.DataFrame(rows, columns=names))
    assert list(got["event"]) == [0, 1, 6, 7]


def test_policy_overlay():
    merged = policy("ranking", {"score_scale": "12", "topic_weights": {"A": 2}, "heat_weight": "bad", "unknown": 1})
    assert merged["score_scale"] == 12.0 and merged["heat_weight"] == 8.0 and merged["topic_weights"] == {"A": 2} and "unknown" not in merged
