"""Oracle SQL per catalog query name."""

from __future__ import annotations

from tidepool_oracle import common as C
from tidepool_oracle import dashboard as DB
from tidepool_oracle import ingest as IG

DETAIL_CUSTOMER = "Customer#000000007"
DETAIL_SUPPLIER = "Supplier#000000003"

LI = dict(history=C.LINEITEM_HISTORY, pairs=C.SUPPLIER_PAIRS)

ORACLE: dict[str, str] = {
    "summary_5": C.summary_sql(5),
    "summary_15": C.summary_sql(15),
    "summary_30": C.summary_sql(30),
    "summary_30_window": C.summary_sql(30),
    "summary_30_series": C.summary_sql(30, second="series"),
    "summary_60_lineitem": C.summary_sql(60, **LI),
    "summaries_all": C.summaries_sql(),
    "summaries_all_lineitem": C.summaries_sql(**LI),
    "pair_details": C.detail_sql(DETAIL_CUSTOMER, 30),
    "pair_details_lineitem": C.detail_sql(DETAIL_SUPPLIER, 60, **LI),
    "metrics_view_60": C.view_sql(60, **LI),
    "metrics_view_events": C.view_sql(60),
}

ORACLE.update(IG.ORACLE)
ORACLE.update(DB.ORACLE)
ORACLE["stream_fee_delta"] = ORACLE["fee_delta"]
ORACLE["export_roundtrip"] = ORACLE["summary_30"]
ORACLE["stream_summaries"] = ORACLE["summaries_all"]
ORACLE["summary_duplicates"] = C.summary_sql(15, history=C.EVENTS_HISTORY_PEERS)
_READY = "SELECT count(DISTINCT created_at) AS update_count, count(DISTINCT created_at) >= 5 AS ready FROM history"
ORACLE["readiness"] = f"WITH {C.EVENTS_HISTORY} {_READY}"
ORACLE["readiness_young"] = f"WITH {C.EVENTS_HISTORY_YOUNG} {_READY}"
ORACLE["late_merged"] = ORACLE["fee_delta"]

LOADED = dict(history=IG.LOADED_HISTORY, pairs=IG.LOADED_PAIRS)
ORACLE.update(
    {
        "summary_loaded_15": C.summary_sql(15, **LOADED),
        "summaries_loaded": C.summaries_sql(**LOADED),
        "update_count_loaded": f"WITH {IG.LOADED_HISTORY} SELECT count(DISTINCT created_at) AS update_count FROM history",
    }
)
ORACLE["stage_snapshot_json"] = ORACLE["stage_snapshot"]
