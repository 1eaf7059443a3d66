"""The daily flow: clean items, unseen rows, unique rows, events, headlines, ledger and lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from briefwright.lexicon import Lexicon
from briefwright.operators import events as E
from briefwright.operators.dedup import deduplicate
from briefwright.operators.filters import score_threshold, with_ad_reason
from briefwright.operators.joins import open_links, unseen
from briefwright.operators.ranking import top_n_per_source
from briefwright.operators.registry import Registry
from briefwright.plans import reports
from briefwright.session import cut_lineage


def clean_top_items(items: DataFrame, threshold: float, max_items: int, ad_config: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows over the threshold without advertising, best ``max_items`` per source."""
    kept = with_ad_reason(score_threshold(items, threshold), ad_config).where("ad_reason is null").drop("ad_reason")
    return top_n_per_source(kept, max_items)


def daily(items: DataFrame, by: Sequence[str] = (), seen: DataFrame | None = None, url_status: DataFrame | None = None, top_n: int = 10,
          lexicon: Lexicon | None = None, ranking: Mapping[str, Any] | None = None, registry: Registry | None = None) -> dict[str, DataFrame]:
    """All tables of a daily run over cleaned items."""
    rows = items if seen is None else unseen(items, seen)
    rows = cut_lineage(deduplicate(rows, by=by))
    if url_status is not None:
        rows, _ = open_links(rows, url_status)
    events, members = E.cluster_events(rows, by, lexicon, ranking, registry)
    chosen = cut_lineage(E.select_headlines(events, top_n, None, ranking))
    return {"items": rows, "events": chosen, "members": members, "ledger": E.event_ledger(chosen, top_n), "supporting": E.supporting_items(members),
            "lines": reports.daily_lines(chosen, members, top_n)}
