"""Skew check: run the ingest and metric plans on a feed where one key holds a
third of all rows, and report per-stage task balance from Spark's event log.

Usage: python tools/skew_check.py [sf_dir]
       python tools/skew_check.py --log <event log folder>   (report only)

The feed is the events feed of the catalog with every third event re-keyed
to one hot address (second run: collapsed into a single snapshot; third run: with
one mint on nine of ten pairs instead).  For
every stage with a shuffle read the script prints the largest task's share of
the stage's shuffle-read records; a stage that funnels a hot key into one
task shows a share near the hot key's share of rows.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def _events(scratch: str):
    """Event-log records (Spark 4 writes a rolling, zstd-compressed log)."""
    for path in sorted(glob.glob(os.path.join(scratch, "**", "events_*"), recursive=True)):
        if path.endswith(".zstd"):
            import io

            import zstandard

            with open(path, "rb") as fh:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
                yield from (json.loads(line) for line in text)
        else:
            with open(path) as fh:
                yield from (json.loads(line) for line in fh)


def main() -> None:
    if len(sys.argv) > 2 and sys.argv[1] == "--log":
        report(sys.argv[2])
        return
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="tidepool-skew-")
    from tidepool.session import build_session

    # Coalescing is off so that each shuffle partition shows its own load
    # (at test sizes AQE would merge every partition into one task).
    spark = build_session(
        shuffle_partitions=16,
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    from tidepool.operators import ingest as I
    from tidepool.operators.tokens import base_tokens
    from tidepool.plans import metrics as M
    from tidepool.plans.load import load_snapshot
    from tidepool.sources import testdata as td
    from tidepool.sources.tables import Tables

    raw = td.events_raw_snapshots(spark, sf_dir)
    hot = F.xxhash64("address", "cumulative_fee_volume", "current_price") % 3 == 0
    skewed = raw.withColumn("address", F.when(hot, F.lit("HOT")).otherwise(F.col("address")))
    one_snapshot = skewed.withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    # A quote token that nine of ten pairs share.
    common = F.when(F.xxhash64("address") % 10 == 0, F.col("mint_y")).otherwise(F.lit("HOT"))
    for label, feed in (("hot address", skewed), ("hot address, one snapshot", one_snapshot), ("hot mint", raw.withColumn("mint_y", common))):
        spark.sparkContext.setJobGroup(label, label)
        t = Tables(os.path.join(scratch, label.replace(" ", "_").replace(",", "")))
        load_snapshot(spark, feed, t, 1)
        M.summaries(t.history(spark), t.pairs(spark), snapshots=t.snapshots(spark)).write.format("noop").mode(
            "overwrite"
        ).save()
        I.stage_snapshot(feed).write.format("noop").mode("overwrite").save()
        base_tokens(t.pairs(spark), t.tokens(spark)).write.format("noop").mode("overwrite").save()
    spark.stop()
    report(scratch)


def report(scratch: str) -> None:
    tasks: dict[tuple[str, int], list[int]] = {}
    names: dict[tuple[str, int], str] = {}
    group_of_job: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    for ev in _events(scratch):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = g
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            sid = ev["Stage ID"]
            tasks.setdefault((stage_group.get(sid, ""), sid), []).append(recs)
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            names[(stage_group.get(info["Stage ID"], ""), info["Stage ID"])] = info["Stage Name"].split(" at ")[0]
    worst = 0.0
    for key in sorted(tasks):
        recs = tasks[key]
        total = sum(recs)
        if total < 1000 or len(recs) < 2:
            continue
        share = max(recs) / total
        worst = max(worst, share)
        print(f"{key[0]:28s} stage {key[1]:4d} tasks {len(recs):3d} shuffle records {total:9d} "
              f"max task share {share:5.2f} median {statistics.median(recs):8.0f}  {names.get(key, '')}")
    print(json.dumps({"worst_task_share": round(worst, 3), "event_log": scratch}))


if __name__ == "__main__":
    main()
