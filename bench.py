"""Headline queries, timed: one JSON line. BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES (comma list) and BENCH_RUNS apply."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caseloom.plans.catalog import QUERIES  # noqa: E402
from caseloom.session import clear_scratch, forget_kept, local_session  # noqa: E402

HEADLINES = [
    "agg_stats_type", "agg_stats_daily", "agg_facets", "agg_timeseries", "agg_address_list", "jn_related",
    "agg_consensus_amount", "jn_blacklist", "relevance", "mentions", "dq_flags", "incident_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = local_session(cpus, app="bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        took = []
        for _ in range(runs):
            forget_kept()  # a query's time holds all that it needs, whichever ran before
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 3)
    clear_scratch(spark)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
