"""Structured Streaming forms of the incremental steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from briefwright.operators.joins import unseen, with_hash
from briefwright.schema import ITEM_DDL
from briefwright.sources.sinks import seen_after


def landed_items(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = ITEM_DDL, files_per_trigger: int = 1000) -> DataFrame:
    """Items as they land. ``state.look_back_step`` judges them by the look-back of their source."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def once_per_hash(items: DataFrame) -> DataFrame:
    """First arrival per content hash inside the watermark; ``state.first_ever`` has no such bound."""
    rows = items if "content_hash" in items.columns else with_hash(items)
    return rows.dropDuplicatesWithinWatermark(["content_hash"])


def publish_batch(seen_path: str, publish: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` step: publish what the permanent table has not seen, then mark it. Seen rows live in one
    folder per batch (``batch=<id>``), so a repeated batch reads the table without its own earlier attempt,
    publishes the same rows and overwrites the same folder. The rows written as seen are the rows published."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{seen_path}/batch={batch_id}"
        try:
            seen = spark.read.parquet(seen_path).where(F.col("batch") != batch_id).drop("batch")
        except Exception as error:  # the table does not exist before the first batch
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            from briefwright.schema import SEEN_DDL

            seen = spark.createDataFrame([], SEEN_DDL)
        rows = batch if "content_hash" in batch.columns else with_hash(batch)
        # one row per hash and per paper id inside the batch
        first = rows.groupBy("content_hash").agg(F.min_by(F.struct(*rows.columns), F.struct("published_at", "url", "title")).alias("r")).select("r.*")
        papers = first.where("coalesce(arxiv_id, '') <> ''").groupBy("arxiv_id").agg(F.min_by(F.struct(*rows.columns), F.struct("published_at", "url", "title")).alias("r")).select("r.*")
        unique = first.where("coalesce(arxiv_id, '') = ''").unionByName(papers)
        fresh = unseen(unique, seen).persist()
        try:
            publish(fresh, batch_id)
            empty = seen.limit(0)
            seen_after(empty, fresh, F.current_timestamp()).write.mode("overwrite").parquet(folder)
        finally:
            fresh.unpersist()

    return step


def weekly_counts(items: DataFrame) -> DataFrame:
    """Items per source and Monday week. The epoch is a Thursday: weeks start four days later."""
    week = F.window("published_at", "7 days", "7 days", "4 days")
    return items.groupBy(week, "source").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").cast("date").alias("week_start"), "source", "n")


def monthly_counts(items: DataFrame) -> DataFrame:
    """Items per source and month, in update mode (calendar months are no fixed window)."""
    return items.groupBy(F.date_trunc("month", "published_at").cast("date").alias("month_start"), "source").agg(F.count(F.lit(1)).alias("n"))


def weekly_term_counts(items: DataFrame, terms: str) -> DataFrame:
    """Occurrences of a term array per Monday week."""
    rows = items.select("published_at", F.explode(terms).alias("term"))
    week = F.window("published_at", "7 days", "7 days", "4 days")
    return rows.groupBy(week, "term").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("date").alias("week_start"), "term", "n")


def usage_windows(records: DataFrame, length: str = "60 minutes", slide: str = "15 minutes", late: str = "1 day") -> DataFrame:
    """Calls and tokens per sliding window; a record (file, line_no, idx) counts once. Needs ``ts``."""
    once = records.withWatermark("ts", late).dropDuplicatesWithinWatermark(["file", "line_no", "idx"])
    return once.groupBy(F.window("ts", length, slide)).agg(F.count(F.lit(1)).alias("calls"), F.sum("total_tokens").alias("total_tokens")).select(
        F.col("window.start").alias("window_start"), "calls", "total_tokens")


def latest_state(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Newest row per key, as an update-mode aggregate."""
    others = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*others), F.col(order)).alias("v")).select(*by, "v.*")


def run_to_completion(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Drain what has landed (available-now trigger) into Parquet files below ``folder``, beside the stream's state, and read them
    back. An aggregate in complete mode is written anew by each batch; the last one holds."""
    spark, out = stream.sparkSession, f"{folder}/rows"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:
        spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(out)  # a table without rows makes no batch
        query = writer.foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(out)).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).parquet(out)
