"""Orders, ranks, cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.session import cut_lineage


def top_k(df: DataFrame, by: Sequence[str | Column], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per group. The rank filter lets Spark cut every map task to k rows per group before
    the shuffle, so a group that holds most of the table still costs k rows per task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def first_per(df: DataFrame, by: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    return top_k(df, by, order, 1)


def ranked(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Exact rank of every row, also in a group of any size: rows are range-partitioned on (group, order),
    ranked inside their partition, and shifted by the number of group rows in earlier partitions."""
    by = list(by)
    placed = cut_lineage(
        df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_pid", F.spark_partition_id()))
    sizes = placed.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("_pid").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in by],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    match = F.col("_pid") == F.col("_p")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    local = F.row_number().over(Window.partitionBy("_pid", *by).orderBy(*order))
    return (placed.withColumn("_local", local).join(shifts, match)
            .withColumn(name, (F.col("_local") + F.col("_shift")).cast("bigint"))
            .drop("_pid", "_p", "_local", "_shift", *[f"_g_{c}" for c in by]))


def running_total(df: DataFrame, value: str, order: Sequence[Column], by: Sequence[str], total: str, rank: str) -> DataFrame:
    """Adds, in groups of any size, the sum of ``value`` over the rows before (``total``) and the rank from 1. Range partitions are summed up
    by themselves and shifted by what earlier partitions hold."""
    by = list(by)
    placed = cut_lineage(df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_pid", F.spark_partition_id()))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_pid", *by).agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    earlier = before(Window.partitionBy(*by).orderBy("_pid"))
    shifts = sums.select(F.col("_pid").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in by],
                         *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_shift{c}") for c in ("_s", "_n")])
    match = F.col("_pid") == F.col("_p")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    local = Window.partitionBy("_pid", *by).orderBy(*order)
    inside = placed.withColumns({"_here": F.coalesce(F.sum(value).over(before(local)), F.lit(0)), "_row": F.row_number().over(local)})
    return inside.join(shifts, match).select(*df.columns, (F.col("_here") + F.col("_shift_s")).cast("bigint").alias(total), (F.col("_row") + F.col("_shift_n")).cast("bigint").alias(rank))


def by_score(descending: bool = True) -> list[Column]:
    return [F.col("score").desc() if descending else F.col("score").asc(), F.col("pos")]


def top_n_per_source(items: DataFrame, max_items: int) -> DataFrame:
    return top_k(items, ["source"], by_score(), max_items)


def sort_by_score(items: DataFrame, descending: bool = True) -> DataFrame:
    return items.orderBy(*by_score(descending))


def top_scored(items: DataFrame, k: int) -> DataFrame:
    """The k best rows of the whole table (one bounded heap per task, then a merge)."""
    return sort_by_score(items).limit(k)


def batches(df: DataFrame, order: Sequence[Column], size: int, by: Sequence[str] = ()) -> DataFrame:
    """Fixed-size batches of an ordered list, numbered from 1."""
    out = ranked(df, order, by, "_row")
    return out.withColumn("batch", (F.floor((F.col("_row") - 1) / size) + 1).cast("int")).drop("_row")


def ordered_distinct(df: DataFrame, value: str, pos: str = "pos") -> DataFrame:
    """Distinct non-blank values with the position of their first appearance."""
    return (df.select(F.trim(value).alias(value), F.col(pos)).where(F.col(value) != "")
            .groupBy(value).agg(F.min(pos).alias("first_pos")))


def latest_per(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Newest row per key, as an aggregate that combines map-side."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*by).agg(F.max_by(row, F.col(order)).alias("_row"))
    return best.select("_row.*")
