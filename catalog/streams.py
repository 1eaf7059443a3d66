"""Streaming queries: the table is read as a stream, drained with the available-now trigger."""


from pyspark.sql import functions as F

from briefwright.session import shared_folder
from briefwright.streaming import state as T, streams as S
from catalog.base import query

def _stream(spark, sf, name):
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    # as a pattern, the path may be one file or a folder of files
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def _drain(spark, df, mode):
    return S.run_to_completion(df, shared_folder(spark), mode)


def events(spark, sf):
    return _stream(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("published_at"), F.col("event_type").alias("source"), "user_id", "value")


#: Rows land by six days of time; of ten rows, one lands two files late.
TILE = "(CAST(CAST(ts AS DATE) AS DATE) - DATE '2024-01-01') // 6"
HOURS = {"click": 14 * 24, "view": 9 * 24}

SS1_SQL = f"""WITH e AS (SELECT event_id, event_type, ts, {TILE} + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END AS k FROM events),
    c AS (SELECT event_type, k, max(max(ts)) OVER (PARTITION BY event_type ORDER BY k) AS latest FROM e GROUP BY 1, 2)
    SELECT event_id FROM e JOIN c USING (event_type, k) WHERE ts >= latest - to_hours(CASE event_type WHEN 'click' THEN {HOURS['click']} WHEN 'view' THEN {HOURS['view']} ELSE 24 END)"""


def _files(rows, number):
    """The rows of each landing file, in order. The tables cover thirty days."""
    return [rows.where(F.col("tile") == k).drop("tile") for k in range(number)]


def _tile(rows):
    return F.floor(F.datediff("published_at", F.lit("2024-01-01").cast("date")) / 6)


def _events(spark, sf):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("published_at"), F.col("event_type").alias("source"), "user_id")


@query("ss1_stream_ingest_lookback", SS1_SQL)
def lookback(spark, sf):
    """Seven files land one after the other; the stream takes each up where it stopped. Late rows of a source with a long look-back
    stay, those of the others go."""
    folder = shared_folder(spark)
    rows = _events(spark, sf)
    rows = rows.withColumn("tile", _tile(rows) + F.when(F.col("event_id") % 10 == 0, 2).otherwise(0))
    publish, read = T.published(spark, folder)
    for part in _files(rows, 7):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = S.landed_items(spark, f"{folder}/landing", schema=part.schema)
        T.drain(stream, folder, T.look_back_step(folder, HOURS, publish))
    return read(part.schema).select("event_id")


@query("ss2_stateful_seen_dedup", """SELECT DISTINCT sha256(event_type || ':' || user_id) AS content_hash FROM events WHERE user_id % 10 <> 0
    UNION SELECT DISTINCT sha256(event_type || ':' || (user_id + 1000000)) FROM events WHERE event_type = 'click'""")
def dedup(spark, sf):
    """Once, ever: five files, the first of them again, and one that lands 120 days later with known and with new keys; a tenth of the users
    is in the permanent table from the beginning."""
    folder = shared_folder(spark)
    rows = _events(spark, sf)
    key = lambda user: F.sha2(F.concat_ws(":", "source", user.cast("string")), 256).alias("content_hash")
    late = F.col("published_at") + F.expr("interval 120 days")
    files = _files(rows.withColumn("tile", _tile(rows)).select("tile", key(F.col("user_id")), "published_at"), 5)
    clicks = rows.where("source = 'click'")
    files += [files[0], rows.select(key(F.col("user_id")), late.alias("published_at")).unionByName(clicks.select(key(F.col("user_id") + 1_000_000), late.alias("published_at")))]
    seen = rows.where("user_id % 10 = 0").select(key(F.col("user_id"))).distinct()
    seen.write.parquet(f"{folder}/seen")
    for part in files:
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = S.landed_items(spark, f"{folder}/landing", schema=part.schema)
        out = S.run_to_completion(T.first_ever(stream, spark.read.schema(seen.schema).parquet(f"{folder}/seen")), folder, "append")
    return out.select("content_hash")


@query("ss3_weekly_term_counts", """SELECT CAST(date_trunc('week', TIMESTAMP '2024-01-01' + to_seconds(doc_id * 104729 % 2592000)) AS DATE) AS week_start, term, count(*) AS n
    FROM (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS term FROM documents) GROUP BY 1, 2""")
def weekly_terms(spark, sf):
    rows = _stream(spark, sf, "documents").select(F.expr("timestampadd(SECOND, cast(doc_id * 104729 % 2592000 as int), timestamp'2024-01-01 00:00:00')").alias("published_at"), F.array_distinct(F.split("text", " ")).alias("terms"))
    return _drain(spark, S.weekly_term_counts(rows, "terms"), "complete")


@query("ss3_tumbling_period_counts", "SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type AS source, count(*) AS n FROM events GROUP BY 1, 2")
def weekly(spark, sf):
    return _drain(spark, S.weekly_counts(events(spark, sf)), "complete")


@query("ss3_monthly_counts", "SELECT CAST(date_trunc('month', ts) AS DATE) AS month_start, event_type AS source, count(*) AS n FROM events GROUP BY 1, 2")
def monthly(spark, sf):
    return _drain(spark, S.monthly_counts(events(spark, sf)), "complete")


@query("ss4_usage_interval_counts", """SELECT w AS window_start, count(*) AS calls, CAST(sum(t) AS BIGINT) AS total_tokens FROM (SELECT user_id AS t, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01') - INTERVAL 45 MINUTE,
    time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01'), INTERVAL 15 MINUTE)) AS w FROM events) GROUP BY w""")
def usage(spark, sf):
    rows = events(spark, sf).select(F.col("published_at").alias("ts"), F.lit("f").alias("file"), F.col("event_id").alias("line_no"), F.lit(0).alias("idx"), F.col("user_id").alias("total_tokens"))
    return _drain(spark, S.usage_windows(rows), "complete")


@query("ss5_latest_state", "SELECT source, event_id FROM (SELECT event_type AS source, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1")
def latest(spark, sf):
    return _drain(spark, S.latest_state(events(spark, sf).select("source", "event_id", "published_at"), ["source"], "published_at"), "complete").select("source", "event_id")
