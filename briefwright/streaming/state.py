"""Streaming steps with a state of their own: rows that were never met before, and look-backs by source."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from briefwright.operators.filters import lookback_hours

#: Keyed state of any size lives in this store; the default one holds it in memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Keys are dealt to so many buckets. It is fixed, as the state of a stream is kept by bucket.
BUCKETS = 4096


class FirstEver(StatefulProcessor):
    """Gives the first row of each key of a bucket, once and for ever: the state is the list of the keys that the bucket has met, without expiry. A call
    takes all rows that a batch brings to the bucket and reads and writes the list as a whole, as a request for each key takes far longer; it
    holds the keys of its bucket and one row of each key of the batch."""

    def __init__(self, columns: Sequence[str], key: str, order: Sequence[str]):
        self.columns, self.key, self.order = list(columns), key, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.met = handle.getListState("met", "key string")

    def _names(self, keys: pd.Series) -> list[str | None]:
        return [None if pd.isna(k) else str(k) for k in keys]

    def handleInputRows(self, bucket, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:  # a bucket's rows come in parts
            both = part if first is None else pd.concat([first, part])
            first = both.sort_values(self.order, kind="stable").drop_duplicates(self.key)
        if first is None:
            return
        names, met = self._names(first[self.key]), {k for k, in self.met.get()}
        new = [k not in met for k in names]
        if any(new):
            self.met.appendList([(k,) for k in names if k not in met])
            yield first[new][self.columns]

    def handleInitialState(self, bucket, initialState: pd.DataFrame, timerValues) -> None:
        self.met.appendList([(k,) for k in self._names(initialState[self.key])])

    def close(self) -> None:
        pass


def first_ever(items: DataFrame, seen: DataFrame | None = None, key: str = "content_hash", order: Sequence[str] = ("published_at",)) -> DataFrame:
    """The first row of each key that the stream has ever brought, whatever the time between two of them; keys of the permanent table
    ``seen`` have been met before the stream began. Replayed files and restarts change nothing. Of the rows of a key in one batch the first by ``order`` is given."""
    items.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    dealt = lambda df: df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    known = dealt(seen.select(key).distinct()).groupBy("_bucket") if seen is not None else None
    return dealt(items).groupBy("_bucket").transformWithStateInPandas(FirstEver(items.columns, key, order), items.schema, "append", "none", known)


def look_back_step(folder: str, hours: Mapping[str, int], publish: Callable[[DataFrame, int], None], default_hours: int = 24) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` step: publishes the rows of a batch that are within the look-back of their source, counted from the latest time
    that the source has had so far, in this batch or before. One watermark for all could not do that: a source that is quiet or
    late would lose its rows by the clock of another.

    The clocks (source, latest) are written anew by each batch, in a folder of its number, from those of the batch before: a repeated batch
    reads the same clocks, writes the same folder and publishes the same rows."""
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        here = batch.where("published_at is not null").groupBy("source").agg(F.max("published_at").alias("latest"))
        if number:
            before = spark.read.schema(here.schema).parquet(f"{folder}/clocks/batch={number - 1}")
            here = before.unionByName(here).groupBy("source").agg(F.max("latest").alias("latest"))
        path = f"{folder}/clocks/batch={number}"
        here.write.mode("overwrite").parquet(path)
        clocks = spark.read.schema(here.schema).parquet(path)
        kept = batch.join(clocks, "source").where(F.col("published_at") >= F.col("latest") - lookback_hours(hours, default_hours)).select(batch.columns)
        publish(kept, number)

    return step


def drain(stream: DataFrame, folder: str, step: Callable[[DataFrame, int], None]) -> None:
    """Run a stream of steps over what has landed; the next call goes on behind it."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def published(spark: SparkSession, folder: str) -> tuple[Callable[[DataFrame, int], None], Callable[..., DataFrame]]:
    """(publish, read): rows in one folder per batch, so that a repeated batch replaces its own."""
    def publish(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    return publish, lambda schema: spark.read.schema(schema).parquet(f"{folder}/rows").drop("batch")
