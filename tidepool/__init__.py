"""tidepool: trailing-window liquidity-pool metrics on Spark.

Public entry points (all take and return DataFrames):

* metrics:   ``summary``, ``summaries``, ``pair_details``, ``metrics_view``
* snapshots: ``update_count``, ``latest_snapshots``, ``eligible_timeframes``
* ingest:    ``stage_snapshot``, ``activity_cutoff``, ``new_tokens``,
             ``new_pairs``, ``fee_deltas``, ``counter_upsert``,
             ``load_snapshot`` (writer), ``constraint_report``
* dashboard: ``opportunities``, ``apply_filter_model``, ``base_tokens``,
             ``token_scores``, ``pair_header``, ``chart_series``,
             ``price_axis``, ``freshness``
* streaming: ``stage_stream``, ``ingest_stream``
* sources:   ``read_pages``, ``read_entries``, ``Tables``; views:
             ``register_views``, ``pair_row``; schemas ``METRICS``, ``SUMMARIES``
"""

from tidepool.operators.filters import apply_filter_model, opportunities
from tidepool.operators.ingest import (
    activity_cutoff,
    counter_upsert,
    fee_deltas,
    new_pairs,
    new_tokens,
    stage_snapshot,
)
from tidepool.operators.quality import constraint_report
from tidepool.operators.reshape import chart_series, price_axis
from tidepool.operators.snapshots import eligible_timeframes, latest_snapshots, update_count
from tidepool.operators.tokens import base_tokens, token_scores
from tidepool.plans.dashboard import freshness, pair_header
from tidepool.plans.load import load_snapshot
from tidepool.plans.metrics import metrics_view, pair_details, summaries, summary
from tidepool.plans.views import pair_row, register_views
from tidepool.schema import METRICS, SUMMARIES
from tidepool.sources.snapshots import read_entries, read_pages
from tidepool.sources.tables import Tables
from tidepool.streaming.ingest import ingest_stream, stage_stream

__all__ = [
    "METRICS",
    "SUMMARIES",
    "Tables",
    "activity_cutoff",
    "apply_filter_model",
    "base_tokens",
    "chart_series",
    "constraint_report",
    "counter_upsert",
    "eligible_timeframes",
    "fee_deltas",
    "freshness",
    "ingest_stream",
    "latest_snapshots",
    "load_snapshot",
    "metrics_view",
    "new_pairs",
    "new_tokens",
    "opportunities",
    "pair_details",
    "pair_header",
    "pair_row",
    "price_axis",
    "read_entries",
    "read_pages",
    "register_views",
    "stage_snapshot",
    "stage_stream",
    "summaries",
    "summary",
    "token_scores",
    "update_count",
]
