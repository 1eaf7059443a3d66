"""Token usage and cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from briefwright.functions.text import epoch_or_iso_ms

COUNTS = ["input_tokens", "cached_input_tokens", "cache_write_tokens", "output_tokens", "total_tokens"]
# Field aliases of the five counts, first non-zero wins.
ALIASES = {
    "input_tokens": ["input_tokens", "input", "prompt_tokens"],
    "cached_input_tokens": ["cached_input_tokens", "cacheRead", "cache_read", "cache_read_tokens"],
    "cache_write_tokens": ["cache_write_tokens", "cacheWrite", "cache_write"],
    "output_tokens": ["output_tokens", "output", "completion_tokens"],
    "total_tokens": ["total_tokens", "totalTokens"],
}
PRICE_FIELDS = ["input", "output", "cacheRead", "cacheWrite"]
# Report labels of the usage sections.
SOURCE_LABELS = {"task": "任务 LLM", "session": "会话本身"}


def price_dimension(spark: SparkSession, path: str) -> DataFrame:
    """(model, input, output, cacheRead, cacheWrite) per million tokens from a provider file."""
    raw = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    return prices_from(raw, "v")


def prices_from(raw: DataFrame, column: str) -> DataFrame:
    providers = raw.select(F.explode(F.map_values(F.try_variant_get(F.try_variant_get(column, "$.providers", "variant"), "$", "map<string,variant>"))).alias("p"))
    models = providers.select(F.explode(F.try_variant_get("p", "$.models", "array<variant>")).alias("m"))
    rate = lambda k: F.coalesce(F.try_variant_get("m", f"$.cost.{k}", "double"), F.lit(0.0)).alias(k)
    return models.select(F.try_variant_get("m", "$.id", "string").alias("model"), *[rate(k) for k in PRICE_FIELDS]).where("model <> ''")


def _count(usage: Column, name: str) -> Column:
    options = [F.nullif(F.try_variant_get(usage, f"$.{alias}", "bigint"), F.lit(0)) for alias in ALIASES[name]]
    return F.coalesce(*options, F.lit(0)).cast("bigint")


def normalised_usage(usage: Column, session_shape: bool = False) -> dict[str, Column]:
    """The five counts of a usage object (variant). Session logs count cached tokens on top of input."""
    counts = {name: _count(usage, name) for name in COUNTS}
    parts = ["input_tokens", "output_tokens"] + (["cached_input_tokens", "cache_write_tokens"] if session_shape else [])
    total = sum((counts[p] for p in parts[1:]), counts[parts[0]])
    counts["total_tokens"] = F.when(counts["total_tokens"] != 0, counts["total_tokens"]).otherwise(total)
    return counts


def response_usage(payload: Column) -> dict[str, Column]:
    """Counts of a response payload (variant): input, cached input, output, total."""
    get = lambda path: F.nullif(F.try_variant_get(payload, f"$.usage.{path}", "bigint"), F.lit(0))
    zero = F.lit(0).cast("bigint")
    given = F.coalesce(get("input_tokens"), get("prompt_tokens"), zero)
    produced = F.coalesce(get("output_tokens"), get("completion_tokens"), zero)
    cached = F.coalesce(*[get(f"{d}.{k}") for d in ("input_tokens_details", "prompt_tokens_details") for k in ("cached_tokens", "cache_read_tokens")], zero)
    return {"input_tokens": given, "cached_input_tokens": cached, "output_tokens": produced,
            "total_tokens": F.coalesce(get("total_tokens"), given + produced)}


def with_cost(entries: DataFrame, prices: DataFrame) -> DataFrame:
    """Adds cost and whether a price is known. Cached tokens without a price of their own cost as input."""
    p = prices.select("model", *[F.coalesce(F.col(k), F.lit(0.0)).alias(f"p_{k}") for k in PRICE_FIELDS])
    rate = lambda k: F.coalesce(f"p_{k}", F.lit(0.0))
    own_or_input = lambda k: F.when(rate(k) > 0, rate(k)).otherwise(rate("input"))
    cached = F.least("cached_input_tokens", "input_tokens")
    fresh = F.greatest(F.col("input_tokens") - cached, F.lit(0))
    cost = (fresh * rate("input") + cached * own_or_input("cacheRead")
            + F.col("cache_write_tokens") * own_or_input("cacheWrite") + F.col("output_tokens") * rate("output")) / 1_000_000
    known = F.lit(False)
    for k in PRICE_FIELDS:
        known = known | (rate(k) > 0)
    return entries.join(p, "model", "left").withColumns({"cost_usd": cost, "price_known": known}).drop(*[f"p_{k}" for k in PRICE_FIELDS])


def usage_records(raw: DataFrame, prices: DataFrame, kind: str = "task_model", source: str = "task") -> DataFrame:
    """Task calls (model, usage variant) to usage entries; empty usage is skipped."""
    entries = raw.withColumns(normalised_usage(F.col("usage"))).where(" or ".join(f"{c} > 0" for c in COUNTS))
    entries = entries.withColumns({"kind": F.lit(kind), "source": F.lit(source)})
    return with_cost(entries, prices).select("kind", "source", "model", *COUNTS, "cost_usd", "price_known")


def log_cost(usage: Column) -> Column:
    """Cost a log row states itself: the total, else the sum of its parts."""
    number = lambda path: F.coalesce(F.try_variant_get(usage, path, "double"), F.lit(0.0))
    part_sum = number("$.cost.input") + number("$.cost.output") + number("$.cost.cacheRead") + number("$.cost.cacheWrite")
    total = F.coalesce(F.nullif(number("$.cost.total"), F.lit(0.0)), F.nullif(number("$.cost.totalCost"), F.lit(0.0)), part_sum)
    has_parts = F.try_variant_get(usage, "$.cost", "map<string,variant>").isNotNull()
    return F.when(has_parts, total).otherwise(
        F.coalesce(F.nullif(number("$.totalCost"), F.lit(0.0)), number("$.estimated_cost_usd")))


def session_usage(lines: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Log lines (file, line_no, value) to usage rows inside [start, end]: usage of every content part, then
    of the message itself. A record is named by file, line and index."""
    parsed = lines.withColumn("v", F.try_parse_json("value")).where("v is not null")
    get = lambda path, kind="string": F.try_variant_get("v", path, kind)
    at = F.coalesce(epoch_or_iso_ms(get("$.timestamp")), epoch_or_iso_ms(get("$.message.timestamp")))
    message = F.coalesce(F.when(get("$.message", "map<string,variant>").isNotNull(), get("$.message", "variant")), F.col("v"))
    rows = parsed.withColumns({"ts_ms": at, "m": message}).where(F.col("ts_ms").between(start_ms, end_ms))
    parts = F.coalesce(F.try_variant_get("m", "$.content", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    records = F.filter(F.concat(parts, F.array("m")), lambda r: F.try_variant_get(r, "$.usage", "map<string,variant>").isNotNull())
    flat = rows.select("file", "line_no", "ts_ms", F.posexplode(records).alias("idx", "r"))
    usage = F.try_variant_get("r", "$.usage", "variant")
    text = lambda path: F.trim(F.coalesce(F.try_variant_get("r", path, "string"), F.lit("")))
    model = F.coalesce(F.nullif(text("$.model"), F.lit("")), F.nullif(text("$.usage.model"), F.lit("")), F.lit("unknown"))
    named = F.when((text("$.provider") != "") & ~model.startswith(F.concat(text("$.provider"), F.lit("/"))),
                   F.concat(text("$.provider"), F.lit("/"), model)).otherwise(model)
    out = flat.withColumns({**normalised_usage(usage, True), "model": named, "cost_usd": F.round(log_cost(usage), 8)})
    return out.where(" or ".join(f"{c} > 0" for c in COUNTS)).select(
        F.lit("session_self").alias("kind"), F.lit("session").alias("source"), "model", *COUNTS, "cost_usd",
        (F.col("cost_usd") > 0).alias("price_known"), "ts_ms", "file", "line_no", "idx")


def usage_rollup(entries: DataFrame) -> DataFrame:
    """Calls, token sums, cost and price flag by model, by source and in total (grouping sets)."""
    sums = ", ".join(f"sum({c}) AS {c}" for c in COUNTS)
    filled = entries.withColumns({
        "model": F.when(F.coalesce("model", F.lit("")) != "", F.col("model")).otherwise("unknown"),
        "source": F.when(F.coalesce("source", F.lit("")) != "", F.col("source")).otherwise(
            F.when(F.col("kind").startswith("session"), "session").otherwise("task"))})
    return filled.sparkSession.sql(f"""
        SELECT CASE WHEN grouping(model) = 0 THEN 'model' WHEN grouping(source) = 0 THEN 'source' ELSE 'total' END AS level,
               coalesce(model, source, 'total') AS name, count(*) AS calls, {sums},
               round(sum(cost_usd), 8) AS cost_usd, bool_or(price_known) AS price_known
        FROM {{entries}} GROUP BY GROUPING SETS ((model), (source), ())""", entries=filled)


def usage_summary(task: DataFrame, session: DataFrame | None = None, reason: str = "未调用 LLM") -> DataFrame:
    """Rollup of task rows plus session rows; one zero row with the reason when there are none."""
    names = ["kind", "source", "model", *COUNTS, "cost_usd", "price_known"]
    merged = task.select(*names) if session is None else task.select(*names).unionByName(session.select(*names))
    rolled = usage_rollup(merged)
    total = rolled.where("level = 'total'")
    zero = total.agg(F.count(F.lit(1)).alias("n"), F.max("calls").alias("c")).where("n = 0 or c = 0").select(
        F.lit("total").alias("level"), F.lit("total").alias("name"), F.lit(0).cast("bigint").alias("calls"),
        *[F.lit(0).cast("bigint").alias(c) for c in COUNTS], F.lit(0.0).alias("cost_usd"), F.lit(False).alias("price_known"))
    rows = rolled.where("calls > 0").withColumn("reason", F.lit(None).cast("string"))
    return rows.unionByName(zero.withColumn("reason", F.lit(reason)))


def model_list(rollup: DataFrame) -> DataFrame:
    return rollup.where("level = 'model'").agg(F.array_join(F.sort_array(F.collect_list("name")), "、").alias("models"))


def usage_lines(rollup: DataFrame, reason: str = "未调用 LLM") -> DataFrame:
    """(ord, line) of the usage section."""
    n = lambda c: F.format_number(F.col(c), 0)
    cost = F.format_string("$%.6f", "cost_usd")
    label = F.col("name")
    for name, shown in SOURCE_LABELS.items():
        label = F.when(F.col("name") == name, shown).otherwise(label)
    bucket = F.concat(F.lit("输入 "), n("input_tokens"), F.lit(" / 缓存 "), n("cached_input_tokens"), F.lit(" / 输出 "),
                      n("output_tokens"), F.lit(" / 总计 "), n("total_tokens"), F.lit(" tokens / 费用 "), cost)
    rows = rollup.withColumns({"label": label, "bucket": bucket})
    join_sorted = lambda cond, value, sep: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(
        cond, F.struct(F.col("name").alias("k"), value.alias("v"))))), lambda x: x["v"]), sep)
    calls = join_sorted(F.col("level") == "source", F.concat(F.col("label"), F.lit(" "), F.col("calls").cast("string")), " + ")
    models = join_sorted(F.col("level") == "model", F.col("name"), "、")
    details = join_sorted(F.col("level") == "model", F.concat("name", F.lit(": "), F.col("calls").cast("string"), F.lit(" calls / "),
                                                               n("total_tokens"), F.lit(" tokens / "), cost), "; ")
    sources = F.transform(F.sort_array(F.collect_list(F.when(F.col("level") == "source", F.struct(F.col("name").alias("k"), F.concat(
        F.lit("- "), "label", F.lit("："), "bucket").alias("v"))))), lambda x: x["v"])
    total = lambda c: F.max(F.when(F.col("level") == "total", F.col(c)))
    one = rows.agg(calls.alias("calls_by"), models.alias("models"), details.alias("details"), sources.alias("sources"),
                   *[total(c).alias(c) for c in ("calls", *COUNTS, "cost_usd")], F.bool_or(F.when(F.col("level") == "total", F.col("price_known"))).alias("price_known"))
    has = F.coalesce("calls", F.lit(0)) > 0
    head = F.when(has, F.concat(F.lit("- LLM 调用："), n("calls"), F.lit("（"), "calls_by", F.lit("）"))).otherwise(f"- LLM 调用：0（{reason}）")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    lines = F.array_compact(F.concat(
        F.array(F.lit("## Token 使用与费用"), F.lit(""), head,
                text("- 模型：", F.when(F.col("models") != "", F.col("models")).otherwise("无")),
                text("- 输入 tokens：", n("input_tokens"), "（缓存命中 ", n("cached_input_tokens"), "）"),
                text("- 输出 tokens：", n("output_tokens")), text("- 总 tokens：", n("total_tokens")), text("- 估算费用：", cost)),
        F.col("sources"),
        F.array(F.when(has & ~F.col("price_known"), "- 备注：本地模型价格未配置或为 0；费用按当前配置估算，实际账单以服务商为准。"),
                F.when(F.col("details") != "", text("- 模型明细：", F.col("details"))))))
    return one.select(F.posexplode(lines).alias("ord", "line"))


def usage_footer(rollup: DataFrame) -> DataFrame:
    """One-line footer of a short message."""
    n = lambda c: F.format_number(F.col(c), 0)
    models = F.array_join(F.sort_array(F.collect_list(F.when(F.col("level") == "model", F.col("name")))), "、")
    total = lambda c: F.max(F.when(F.col("level") == "total", F.col(c))).alias(c)
    row = rollup.agg(models.alias("models"), *[total(c) for c in ("calls", "input_tokens", "output_tokens", "total_tokens", "cost_usd")],
                     F.bool_or(F.when(F.col("level") == "total", F.col("price_known"))).alias("price_known"))
    base = F.concat(F.lit("Token 使用与费用：输入 "), n("input_tokens"), F.lit(" / 输出 "), n("output_tokens"), F.lit(" / 总计 "),
                    n("total_tokens"), F.lit(" tokens；模型 "), "models", F.lit("；估算费用 "), F.format_string("$%.6f", "cost_usd"))
    noted = F.when(F.col("price_known"), base).otherwise(F.concat(base, F.lit("（本地价格未配置/为 0，实际账单以服务商为准）")))
    return row.select(F.when(F.col("calls") > 0, noted).otherwise("Token 使用与费用：未调用 LLM；费用 $0.000000").alias("footer"))
