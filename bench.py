"""Time the headline queries: python bench.py prints one JSON line.

Each query is run twice to a sink that discards its rows; the better run counts, so that
compiling generated code is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwatch.plans.queries import QUERIES  # noqa: E402
from shelfwatch.session import build_session  # noqa: E402

HEADLINE = (
    "daily_sales",
    "feature_table",
    "lag_features",
    "calendar_lag",
    "pit_join",
    "chrono_split",
    "sample_exact",
    "quantile_edges",
    "psi_numeric",
    "psi_categorical",
    "psi_report",
    "ks_statistic",
    "tokenize",
    "token_precision",
    "cosine_clip",
    "score_faithfulness",
    "scan_eval_jsonl",
    "request_rate_5m",
    "latency_quantiles_5m",
    "stream_request_rate_5m",
    "stream_psi",
    "validate_requests",
    "expand_horizon",
    "forecast_requests_baseline",
    "compare_models",
    "train_regressor",
    "forecast_requests",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(f"{name}: {runs}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, better of two runs, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
