"""Streams with a state of their own, over files that land one after the other."""

import datetime

from pyspark.sql import functions as F

from briefwright.streaming import state, streams

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2026, 1, 1)


def land(spark, rows, path, schema):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def test_look_back_of_each_source(spark, tmp_path):
    schema, folder = "source string, published_at timestamp, url string", str(tmp_path)
    files = [[("slow", START, "a"), ("fast", START + 20 * DAY, "b"), ("slow", None, "n")],
             [("slow", START - 4 * DAY, "c"), ("fast", START + 18 * DAY, "d"), ("fast", START + 19 * DAY, "e"), ("slow", START + 9 * DAY, "f")],
             [("slow", START + 3 * DAY, "g"), ("slow", START + DAY, "h"), ("new", START - 90 * DAY, "i")]]
    publish, read = state.published(spark, folder)
    steps = []
    for rows in files:
        land(spark, rows, f"{folder}/landing", schema)
        step = state.look_back_step(folder, {"slow": 24 * 7}, publish)
        state.drain(streams.landed_items(spark, f"{folder}/landing", schema=schema), folder, lambda b, n, step=step: (steps.append((b.collect(), n)), step(b, n)))
    want = sorted("abefgi")
    assert sorted(r.url for r in read(schema).collect()) == want
    # a repeated batch publishes the same rows again, in its place
    for rows, number in steps:
        state.look_back_step(folder, {"slow": 24 * 7}, publish)(spark.createDataFrame(rows, schema), number)
    assert sorted(r.url for r in read(schema).collect()) == want


def test_once_ever(spark, tmp_path):
    schema, folder = "content_hash string, published_at timestamp, url string", str(tmp_path)
    seen = spark.createDataFrame([("old",), ("old",)], "content_hash string")
    files = [[("a", START, "1"), ("a", START - DAY, "0"), ("old", START, "2"), (None, START, "3")], [("a", START, "1"), ("b", START, "4")], [("b", START + 200 * DAY, "5"), ("c", START - 200 * DAY, "6"), ("old", START + 400 * DAY, "7"), (None, START, "8")]]
    for rows in files:
        land(spark, rows, f"{folder}/landing", schema)
        out = streams.run_to_completion(state.first_ever(streams.landed_items(spark, f"{folder}/landing", schema=schema), seen), folder)
    assert sorted((r.content_hash or "", r.url) for r in out.collect()) == [("", "3"), ("a", "0"), ("b", "4"), ("c", "6")]
    assert out.where(F.col("content_hash") == "old").count() == 0


def test_streamed_table_is_a_file_a_folder_or_empty(spark, tmp_path):
    from catalog import load

    weekly = load().QUERIES["ss3_weekly_term_counts"]
    docs = [(k, "a b" if k % 2 else "a c a") for k in range(6)]
    want = sorted([("a", 6), ("b", 3), ("c", 3)])
    folder, single, empty = (str(tmp_path / n) for n in ("folder", "single", "empty"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    frame.coalesce(1).write.parquet(f"{single}/parts")
    part = next((tmp_path / "single" / "parts").glob("*.parquet"))
    (tmp_path / "single" / "documents.parquet").write_bytes(part.read_bytes())
    frame.limit(0).write.parquet(f"{empty}/documents.parquet")
    for sf, rows in ((folder, want), (single, want), (empty, [])):
        found = weekly(spark, sf).groupBy("term").agg(F.sum("n").alias("n"))
        assert sorted((r.term, r.n) for r in found.collect()) == rows, sf


def test_once_ever_calls_take_many_keys(spark, tmp_path, monkeypatch):
    """Keys are dealt to buckets: with one bucket, one call takes all of them, and each key still comes once, by its first row."""
    monkeypatch.setattr(state, "BUCKETS", 1)
    schema, folder = "content_hash string, published_at timestamp, url string", str(tmp_path)
    seen = spark.createDataFrame([(f"k{i}",) for i in range(0, 200, 10)], "content_hash string")
    files = [[(f"k{i}", START + d * DAY, f"{i}-{d}") for i in range(100) for d in (2, 1)], [(f"k{i}", START, f"{i}-0") for i in range(50, 200)], [(None, START, "n"), (None, START, "n")]]
    for rows in files:
        land(spark, rows, f"{folder}/landing", schema)
        out = streams.run_to_completion(state.first_ever(streams.landed_items(spark, f"{folder}/landing", schema=schema), seen), folder)
    want = [f"{i}-1" if i < 100 else f"{i}-0" for i in range(200) if i % 10] + ["n"]
    assert sorted(r.url for r in out.collect()) == sorted(want)
