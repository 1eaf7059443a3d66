"""Calendar windows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions.markdown import clean_label, markdown_link
from briefwright.functions.text import text_or_empty

PERIODS = ("weekly", "monthly", "quarterly", "semiannual", "annual")
# Report words of the periods.
PERIOD_NAMES = {"weekly": "周报", "monthly": "月报", "quarterly": "季报", "semiannual": "半年报", "annual": "年报"}


def period_name(period: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, shown in PERIOD_NAMES.items():
        out = F.when(period == name, shown).otherwise(out)
    return out


def period_bounds(ref: Column, period: str, completed: bool = False) -> Column:
    """Struct (start, end, key) of the period that holds ``ref``, or of the last completed one. A week is
    always the ISO week of the reference day."""
    first = lambda unit, d: F.trunc(d, unit)
    if completed and period != "weekly":
        unit = {"monthly": "month", "quarterly": "quarter", "annual": "year"}.get(period)
        half = F.when(F.month(ref) <= 6, F.trunc(ref, "year")).otherwise(F.add_months(F.trunc(ref, "year"), 6))
        ref = F.date_sub(first(unit, ref) if unit else half, 1)
    if period == "weekly":
        start = F.trunc(ref, "week")
        key = F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), ref).cast("int"), F.weekofyear(ref))
        return F.struct(start.alias("start"), F.date_add(start, 6).alias("end"), key.alias("key"))
    if period == "semiannual":
        second = F.month(ref) > 6
        start = F.when(second, F.add_months(F.trunc(ref, "year"), 6)).otherwise(F.trunc(ref, "year"))
        months, key = 6, F.concat(F.date_format(start, "yyyy"), F.when(second, "-H2").otherwise("-H1"))
    else:
        unit = {"monthly": "month", "quarterly": "quarter", "annual": "year"}[period]
        months = {"monthly": 1, "quarterly": 3, "annual": 12}[period]
        start = first(unit, ref)
        key = {"monthly": F.date_format(start, "yyyy-MM"), "annual": F.date_format(start, "yyyy"),
               "quarterly": F.concat(F.date_format(start, "yyyy"), F.lit("-Q"), F.quarter(start).cast("string"))}[period]
    return F.struct(start.alias("start"), F.date_sub(F.add_months(start, months), 1).alias("end"), key.alias("key"))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def shift_month(day: Column, delta: Column | int) -> Column:
    """First day of the month ``delta`` months away."""
    return F.add_months(F.trunc(day, "month"), delta)


def months_between(start: Column, end: Column) -> Column:
    """Month keys from start to end."""
    return F.transform(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")), month_key)


def local_day_bounds(ts: Column, zone: str) -> Column:
    """Struct (start, end) of the calendar day of ``zone`` that holds ``ts``, as instants."""
    day = F.date_trunc("day", F.from_utc_timestamp(ts, zone))
    return F.struct(F.to_utc_timestamp(day, zone).alias("start"), F.to_utc_timestamp(day + F.expr("interval 1 day"), zone).alias("end"))


def report_time(ts: Column, offset_hours: int = 8) -> Column:
    return F.date_format(ts + F.expr(f"interval {offset_hours} hours"), "yyyy-MM-dd HH:mm")


def date_label(label: Column, start: Column, end: Column) -> Column:
    own, a, b = (F.trim(text_or_empty(c)) for c in (label, start, end))
    return (F.when(own != "", own).when((a != "") & (b != "") & (a != b), F.concat(a, F.lit("–"), b))
            .when(a != "", a).otherwise("时间待公布"))


def focus_text(focus: Column, note: Column) -> Column:
    items = F.slice(F.filter(F.transform(F.coalesce(focus, F.expr("cast(array() as array<string>)")), lambda x: F.trim(x)), lambda x: x != ""), 1, 5)
    joined = F.when(F.size(items) > 0, F.concat(F.lit("关注点："), F.array_join(items, "、")))
    extra = F.nullif(F.trim(text_or_empty(note)), F.lit(""))
    return F.concat_ws("；", joined, extra)


def event_line(c=F.col) -> Column:
    meta = F.concat_ws(" / ", date_label(c("date_label"), c("start_date"), c("end_date")),
                       F.nullif(F.trim(text_or_empty(c("organizer"))), F.lit("")), F.nullif(F.trim(text_or_empty(c("location"))), F.lit("")))
    focus = focus_text(c("focus"), c("note"))
    return F.concat(F.lit("- "), meta, F.lit("："), markdown_link(clean_label(c("title")), c("url")),
                    F.when(focus != "", F.concat(F.lit(" — "), focus)).otherwise(""))


def iso_date(text: Column) -> Column:
    return F.try_to_date(F.substring(F.trim(text_or_empty(text)), 1, 10), "yyyy-MM-dd")


def event_window(events: DataFrame, today: Column, config: Mapping[str, Any] | None = None) -> DataFrame:
    """Calendar rows in view on a day: ``upcoming`` (inside the horizon, and imminent, or on the weekly reminder
    day, or always shown), ``recent`` and ``undated``, each sorted and capped. ``slot`` is the place in it."""
    cfg = {"horizon_days": 30, "recent_days": 30, "imminent_days": 7, "weekly_reminder_weekday": 0,
           "max_upcoming": 8, "max_recent": 4, "max_undated": 5, **dict(config or {})}
    reminder = F.weekday(today) == cfg["weekly_reminder_weekday"]
    shown = reminder | F.coalesce("always_show", F.lit(False))
    rows = events.where("coalesce(enabled, true)").withColumns({
        "_start": iso_date(F.col("start_date")), "_today": today, "_priority": F.coalesce(F.nullif("priority", F.lit(0)), F.lit(50))})
    rows = rows.withColumn("_end", F.coalesce(iso_date(F.col("end_date")), F.col("_start")))
    over = F.col("_end") < F.col("_today")
    bucket = (
        F.when(F.col("_start").isNull(), F.when(shown, "undated"))
        .when(over, F.when((F.col("_end") >= F.date_sub("_today", cfg["recent_days"])) & shown, "recent"))
        .when((F.col("_start") <= F.date_add("_today", cfg["horizon_days"]))
              & ((F.datediff("_start", "_today") <= cfg["imminent_days"]) | shown), "upcoming"))
    rows = rows.withColumn("bucket", bucket).where("bucket is not null")
    day = F.coalesce("_start", F.lit("9999-12-31").cast("date"))
    forward = [day, F.col("_priority"), F.coalesce("title", F.lit(""))]
    limits = {"upcoming": (cfg["max_upcoming"], forward), "undated": (cfg["max_undated"], forward),
              "recent": (cfg["max_recent"], [c.desc() for c in forward])}
    out = None
    for name, (cap, order) in limits.items():
        part = rows.where(F.col("bucket") == name).withColumn("slot", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).where(F.col("slot") <= cap)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("line", event_line()).drop("_start", "_end", "_today", "_priority")
