"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telepulse.plans.catalog import QUERIES  # noqa: E402
from telepulse.session import build_session  # noqa: E402

HEADLINE = [
    "fleet_daily_health",
    "device_status_summary",
    "zone_activity",
    "window_stats",
    "window_stats_daily",
    "fleet_kpis",
    "kpi_history",
    "quality_checks",
    "latest_per_device_day",
    "temperature_statistics",
    "speed_and_battery_analysis",
    "device_status_report",
    "run_sql",
    "accepted_events",
    "reject_summary",
    "metric_period_stat",
    "evaluate_alarms",
    "alarm_transitions",
    "render_chat",
    "render_email_html",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "telepulse-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(HEADLINE[0])  # start the engine before the clock
    seconds = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
