"""Scans of landed tables and files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from briefwright.functions import text as T
from briefwright.operators.ranking import first_per
from briefwright.operators.usage import session_usage
from briefwright.schema import FEEDBACK_DDL, HEALTH_DDL, ITEM_DDL

# File name forms.
SNAPSHOT_NAME = r"collected-(\d{4}-\d{2}-\d{2})-(\d{4})\.json$"
REPORT_NAME = r"digest-(\d{4}-\d{2}-\d{2})-\d{4}\.md$"


def newest_file(rows: DataFrame, date: str = "dt", file: str = "file", modified: str = "modified") -> DataFrame:
    """Rows of the newest file of every date. The choice is one small aggregate over (date, file); the rows
    themselves are joined with its result, never sorted."""
    files = rows.groupBy(date, file).agg(F.max(modified).alias("_m"))
    newest = files.groupBy(date).agg(F.max_by(file, F.struct("_m", file)).alias(file))
    return rows.join(newest, [date, file], "left_semi")


def snapshots(spark: SparkSession, path: str, fail_fast: bool = False) -> DataFrame:
    """All snapshot files of a folder as items with date, file, modification time and place."""
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    raw = spark.read.schema(ITEM_DDL).option("multiLine", True).option("mode", mode).option("pathGlobFilter", "collected-*.json").json(path)
    named = raw.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("modified"),
                       F.monotonically_increasing_id().alias("pos"))
    return named.withColumn("dt", F.regexp_extract("file", SNAPSHOT_NAME, 1)).where("dt <> ''")


def latest_snapshot(spark: SparkSession, path: str, date: str) -> DataFrame:
    return newest_file(snapshots(spark, path).where(F.col("dt") == date))


def snapshot_lookup(spark: SparkSession, path: str, date: str) -> DataFrame:
    """As ``latest_snapshot``, rows validated; raises when the date has no file."""
    rows = snapshots(spark, path, fail_fast=True).where(F.col("dt") == date)
    if rows.select("file").limit(1).isEmpty():
        raise FileNotFoundError(f"no snapshot for {date} in {path}")
    return newest_file(rows)


def item_key() -> Column:
    return F.when(T.text_or_empty(F.col("url")) != "", F.col("url")).otherwise(
        F.concat(T.text_or_empty(F.col("source")), F.lit("::"), T.text_or_empty(F.col("title"))))


def date_range(rows: DataFrame, start, end, by: Sequence[str] = ()) -> DataFrame:
    """Rows of snapshots dated in [start, end], first occurrence of a link (else source and title) in file
    order. The date filter is on the partition column, so only the files of the range are read."""
    inside = rows.where(F.col("dt").between(start, end))
    return first_per(inside.withColumn("_k", item_key()), [*by, "_k"], [F.col("file"), F.col("pos")]).drop("_k")


def available_dates(rows: DataFrame, end, days: int) -> DataFrame:
    """Distinct snapshot dates of the last ``days`` days."""
    last = F.lit(end).cast("date")
    return rows.select(F.col("dt").cast("date").alias("dt")).where(F.col("dt").between(F.date_sub(last, max(1, days) - 1), last)).distinct()


def latest_health(spark: SparkSession, path: str, date: str) -> DataFrame:
    raw = spark.read.schema(HEALTH_DDL).option("multiLine", True).option("pathGlobFilter", f"source-health-{date}-*.json").json(path)
    rows = raw.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), F.lit(date).alias("dt"))
    return newest_file(rows)


def report_corpus(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """(report_id, dt, markdown) of the daily reports named in [start, end]."""
    raw = spark.read.option("pathGlobFilter", "digest-*.md").text(path, wholetext=True)
    rows = raw.select(F.col("_metadata.file_name").alias("report_id"), F.col("value").alias("markdown"))
    return rows.withColumn("dt", F.regexp_extract("report_id", REPORT_NAME, 1)).where((F.col("dt") != "") & F.col("dt").between(start, end))


def parse_feedback(lines: DataFrame, column: str = "value") -> DataFrame:
    """Readable JSON lines as feedback rows; malformed lines are skipped."""
    ddl = FEEDBACK_DDL + ", _bad STRING"
    parsed = lines.where(F.trim(column) != "").select(F.from_json(column, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r._bad is null").select("r.*").drop("_bad")


def feedback_scan(spark: SparkSession, path: str, date: str) -> DataFrame:
    return parse_feedback(spark.read.text(path)).where(F.col("date") == date)


def usage_log_scan(spark: SparkSession, path: str, start_ms: int, end_ms: int) -> DataFrame:
    """Session logs to usage rows in [start, end]; checkpoint files and files older than a day before the
    window are not opened. The record id is (file, byte order of the line, index)."""
    since = spark.sql(f"select date_format(timestamp_millis({start_ms - 86_400_000}), \"yyyy-MM-dd'T'HH:mm:ss\")").first()[0]
    raw = spark.read.option("pathGlobFilter", "*.jsonl").option("modifiedAfter", since).text(path)
    rows = raw.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"))
    return session_usage(rows.where(~F.col("file").contains(".checkpoint.")), start_ms, end_ms)


def queue_append(new_urls: DataFrame, queue: DataFrame, added_at: str) -> DataFrame:
    """Queue rows for URLs that are neither pending nor archived, once each."""
    fresh = new_urls.select(F.trim("url").alias("url")).where("url <> ''").distinct()
    known = queue.select("url").distinct()
    return fresh.join(known, "url", "left_anti").select("url", F.lit(added_at).alias("added_at"), F.lit(False).alias("processed"))


def queue_drain(queue: DataFrame, processed_at: Column) -> tuple[DataFrame, DataFrame]:
    """(items, queue after): open rows become items and move to the archive state."""
    from briefwright.sources.payloads import manual_items

    usable = (~F.coalesce("processed", F.lit(False))) & (F.trim(T.text_or_empty(F.col("url"))) != "")
    after = queue.withColumns({
        "processed_at": F.when(usable, processed_at).cast("timestamp"),
        "processed": F.coalesce("processed", F.lit(False)) | usable})
    return manual_items(queue), after.withColumn("state", F.when(F.col("processed"), "archive").otherwise("pending"))
