"""Skew probe: hotel top-k with one city holding a third of all offers.

Runs three plans on the same derived offers and reports, from Spark's event
log (written to a fresh scratch folder), the rows shuffled and the largest
number of rows any single task read from a shuffle:

* broadcast   — range table broadcast, WindowGroupLimit before the exchange
* salted      — range table over budget: salted shuffle join, two-stage rank
* naive       — min/max and rank as windows over the raw offers (one exchange)

Usage: python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from waymark.operators import hotels  # noqa: E402
from waymark.plans import driver  # noqa: E402


def naive_top3(offers, keys, price, review):
    w = Window.partitionBy(*keys)
    scored = (offers.filter(F.col("l_returnflag") == "R")
              .withColumn("diff_price", F.max(price).over(w) - F.min(price).over(w))
              .withColumn("diff_review", F.max(review).over(w) - F.min(review).over(w))
              .withColumn("total_points",
                          F.lit(70) - (F.col(price) - F.min(price).over(w)) * 70 / F.nullif("diff_price", F.lit(0.0))
                          + (F.col(review) - F.min(review).over(w)) * 30 / F.nullif("diff_review", F.lit(0.0))))
    r = F.rank().over(Window.partitionBy(*keys).orderBy(F.col("total_points").desc_nulls_last()))
    return scored.withColumn("rank", r).filter("rank <= 3")


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="waymark-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             # measure the planned partitioning, not AQE packing tiny partitions together
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # one (city, month) group gets every offer whose order key is divisible by 3: a third of all rows
    hot = F.col("l_orderkey") % 3 == 0
    offers = driver.lineitem_offers(spark, base).withColumns({
        "l_suppkey": F.when(hot, F.lit(-1)).otherwise(F.col("l_suppkey")),
        "ship_month": F.when(hot, F.lit("1995-01-01").cast("date")).otherwise(F.col("ship_month"))})
    spark.conf.set("waymark.skew.rowsPerTask", "10000")
    args = driver.OFFER_ARGS
    runs = {
        "broadcast": lambda: hotels.hotel_top3(offers, **args),
        "salted": lambda: hotels.hotel_top3(offers, broadcast_max_bytes=0, **args),
        "naive": lambda: naive_top3(offers, args["keys"], args["price"], args["review"]),
    }
    counts = {}
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df = build()
        counts[name] = df.count()
    spark.stop()
    logs = sorted(p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p))
    stats: dict[str, dict[str, int]] = {}
    group_of_job: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    per_stage: dict[tuple[str, int], list[int]] = {}
    lines = (line for path in logs for line in open(path))
    for line in lines:
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
            group_of_job[ev["Job ID"]] = g
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = g
        elif kind == "SparkListenerTaskEnd":
            g = stage_group.get(ev["Stage ID"], "")
            m = ev.get("Task Metrics") or {}
            w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
            rd = m.get("Shuffle Read Metrics") or {}
            r = rd.get("Total Records Read", 0)
            s = stats.setdefault(g, {"shuffled_rows": 0, "max_task_shuffle_read": 0})
            s["shuffled_rows"] += w
            s["max_task_shuffle_read"] = max(s["max_task_shuffle_read"], r)
            if os.environ.get("PROBE_STAGES"):
                per_stage.setdefault((g, ev["Stage ID"]), []).append(r)
    for name in runs:
        print(json.dumps({"plan": name, "result_rows": counts[name], **stats.get(name, {})}))
    for (g, sid), reads in sorted(per_stage.items()):
        print(g, sid, "tasks", len(reads), "max read", max(reads), "total read", sum(reads))


if __name__ == "__main__":
    main()
