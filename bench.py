"""Time the headline queries: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose tables and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flow_clean_top_items", "fl17_three_way_route", "ag08_usage_rollup", "jn01_seen_anti_join", "wn04_event_rank", "st13_entities",
    "nr01_x_list_tweets", "sr19_event_score", "cl03_theme_clustering", "rp09_monthly_report_lines",
    "cl01_deduplicate", "rp03_size_bounded_chunks",
]


def main() -> None:
    from briefwright.session import build_session
    from catalog import load

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().QUERIES
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    small = os.path.join(os.path.dirname(os.path.normpath(sf)), "sf0.001")
    if os.path.isdir(small):  # starts the session and the Python workers before the first timing
        queries[names[0]](spark, small).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(os.path.normpath(sf)).removeprefix("sf")}))


if __name__ == "__main__":
    main()
