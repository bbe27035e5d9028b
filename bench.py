"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS`` (default 8) the
cores. Each query runs twice, its whole result written to Spark's no-op sink, and the second run
counts; ``first_run`` holds the others.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapeflow.plans.catalog import QUERIES  # noqa: E402
from tapeflow.session import build_session  # noqa: E402

HEADLINE = (
    "tumbling_1m",
    "sliding_5m_1m",
    "tumbling_1m_lineitem",
    "dedup_recent",
    "flag_spikes_by_range",
    "ingest_messages",
    "symbol_stats",
    "stats_snapshots",
    "dedup_recent_2000",
    "window_features",
    "predict_prices",
    "isolation_forest",
    "stream_tumbling_1m",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    timings, first = {}, {}
    for name in HEADLINE:
        first[name], timings[name] = run(name), run(name)
        print(f"{name}: {timings[name]} s", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "first_run": first,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
