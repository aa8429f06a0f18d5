"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.plans.registry import ANALYTICS, MODELS, registered  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    *ANALYTICS,
    "dq_report",
    "keep_first",
    "sentiment_score",
    "dense_demand",
    "demand_features",
    "horizon_targets",
    "sliding_baselines",
    "forecast_metrics",
    "residual_intervals",
    "category_leaderboard",
    "inventory_plan",
    *MODELS,
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("monthly_demand_trend")  # start the executors before the clock
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
