"""Benchmark: seconds per registered query at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list). Each query is executed in full through
the ``noop`` sink (every row computed, nothing collected to the driver).

Every query runs twice. The first (cold) run pays one-off costs that do not
grow with the data: Python-side plan building, analysis and code generation
for that plan shape. ``queries`` / ``value`` report the second (warm) run,
the steady state of a long-lived cluster session; ``cold_queries`` /
``cold_value`` keep the first run. Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from creamery.queries import QUERIES  # noqa: E402
from creamery.session import local_session  # noqa: E402

# The marts and facts a deployment runs every day, the live path, and the full file-to-gold run.
HEADLINE = [
    "fact_production_batches",
    "fact_shipments",
    "fact_quality_audits",
    "fact_sensor_readings",
    "d_production_summary",
    "d_retailer_360",
    "d_quality_audit_summary",
    "d_sensor_health_summary",
    "d_audit_sentiment",
    "expectations_report",
    "stream_bronze_run",
    "cq_plant_ranking",
    "cq_exec_kpis",
    "cq_health_by_source",
    "medallion_files_to_gold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(
        master=f"local[{cpus}]",
        app_name="creamery-bench",
        shuffle_partitions=max(2 * cpus, 8),
        driver_memory="16g",
    )
    # Warm the JVM (class loading, codegen caches) on a small query; not timed.
    QUERIES["silver_dim_plants"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    cold: dict[str, float] = {}
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            for runs in (cold, timings):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep measuring the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}"
            cold.pop(name, None)
            timings.pop(name, None)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "cold_value": round(sum(cold.values()), 3),
                "cold_queries": cold,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "errors": errors,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
