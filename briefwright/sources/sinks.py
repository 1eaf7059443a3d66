"""Sinks. Merges are pure functions from (old, new) to the table after, so a batch job writes them as a new
version and a stream runs them in ``foreachBatch``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from briefwright.operators.joins import with_hash
from briefwright.schema import SEEN_DDL

_SEEN = ["source", "url", "title", "arxiv_id"]


def _value(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def write_snapshot(items: DataFrame, path: str, date: str | Column, run_ts: str | Column, fmt: str = "parquet") -> None:
    """Items of one run, or of several, below date and run time; a run replaces only its own partition."""
    rows = items.withColumns({"dt": _value(date), "run_ts": _value(run_ts)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "run_ts").format(fmt).save(path)


def source_health(results: DataFrame, date: str, run_ts: str) -> DataFrame:
    """Health rows of a run from its source results (source, success, error, repair columns)."""
    optional = lambda c, kind: F.col(c) if c in results.columns else F.lit(None).cast(kind)
    return results.select(
        F.lit(date).alias("date"), F.lit(run_ts).alias("run_ts"), "source", "success", optional("repair_status", "string").alias("repair_status"),
        optional("repair_actions", "array<string>").alias("repair_actions"), optional("repair_notes", "array<string>").alias("repair_notes"),
        optional("error", "string").alias("error"))


def append_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def seen_after(seen: DataFrame, published: DataFrame, now: Column) -> DataFrame:
    """Seen table after publishing: new hashes enter, known ones keep their first row and get a new last-seen
    time. Both sides aggregate map-side by hash."""
    rows = published if "content_hash" in published.columns else with_hash(published)
    order = F.col("pos") if "pos" in rows.columns else F.lit(0)
    fresh = rows.select("content_hash", *_SEEN, now.alias("first_seen_at"), now.alias("last_seen_at"), F.lit(1).alias("_age"), order.cast("bigint").alias("_o"))
    old = seen.select("content_hash", *_SEEN, "first_seen_at", "last_seen_at", F.lit(0).alias("_age"), F.lit(0).cast("bigint").alias("_o"))
    first = F.min_by(F.struct(*_SEEN, "first_seen_at"), F.struct("_age", "_o"))
    merged = old.unionByName(fresh).groupBy("content_hash").agg(first.alias("f"), F.max("last_seen_at").alias("last_seen_at"))
    return merged.select("content_hash", *[f"f.{c}" for c in _SEEN], "f.first_seen_at", "last_seen_at")


def runs_after(runs: DataFrame, records: DataFrame) -> DataFrame:
    """Run table after saving records: a known run keeps date, phase and start and takes the new outcome.
    ``saved_at`` orders the saves."""
    mark = lambda df, n: df.withColumn("_v", F.struct(F.lit(n).alias("n"), F.col("saved_at") if "saved_at" in df.columns else F.lit(None).cast("timestamp").alias("saved_at")))
    keep, change = ["date", "phase", "started_at"], ["finished_at", "status", "result_json", "error"]
    both = mark(runs, 0).select("run_id", *keep, *change, "_v").unionByName(mark(records, 1).select("run_id", *keep, *change, "_v"))
    merged = both.groupBy("run_id").agg(F.min_by(F.struct(*keep), F.col("_v")).alias("k"), F.max_by(F.struct(*change), F.col("_v")).alias("c"))
    return merged.select("run_id", "k.*", "c.*")


def write_ledger(ledger: DataFrame, path: str, date: str | Column, generated_at: str | Column) -> None:
    """Dated ledger partition; ``latest_ledger`` reads the newest one back."""
    rows = ledger.withColumns({"dt": _value(date), "generated_at": _value(generated_at)})
    rows.write.mode("append").partitionBy("dt", "generated_at").parquet(path)


def latest_ledger(ledger: DataFrame) -> DataFrame:
    newest = ledger.agg(F.max(F.struct("generated_at", "dt")).alias("m")).select("m.*")
    return ledger.join(F.broadcast(newest), ["dt", "generated_at"], "left_semi")


def write_evaluation(metrics: DataFrame, labels: DataFrame, path: str) -> None:
    """Daily metrics and audit label counts; a day replaces only its own partition."""
    for rows, name in ((metrics, "metrics"), (labels, "labels")):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{path}/{name}")


def write_period_report(meta: DataFrame, report: DataFrame, path: str) -> None:
    """Metadata rows and report texts, one partition per period key."""
    meta.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{path}/meta")
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{path}/text")


def manual_suggestions(items: DataFrame, minutes: int = 30) -> DataFrame:
    """Items that need manual handling, with their duration and the reason."""
    duration = F.coalesce(F.try_variant_get(F.try_parse_json("extra"), "$.duration", "string"), F.lit(""))
    return items.select("title", "url", "source", duration.alias("duration"), F.lit(f"large_download (>{minutes} min)").alias("reason"))
