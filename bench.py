"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  input tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores    (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parcelwise.checks.queries import QUERIES  # noqa: E402
from parcelwise.session import build_session  # noqa: E402

HEADLINE = [
    "profile_nulls",
    "clean_orders",
    "dq_report",
    "fact_orders",
    "monthly_risk_by_region",
    "department_kpis",
    "segment_risk",
    "auc_roc",
    "forecast_risk_by_region",
    "flag_anomalies",
    "isolation_forest_score",
    "build_risk_scores",
    "risk_matrix",
    "kpi_cards",
    "train_late_risk_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # One untimed run, so that JVM start-up and class loading hit no query.
    QUERIES["monthly_risk_by_region"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
