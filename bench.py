"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully computed through the ``noop`` sink (no collect), after
one warm-up query so JVM start-up is not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablefit.session import get_session  # noqa: E402
from tablefit.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "parameter_sweep",        # the main run: 92 fits
    "regression_sweep",       # linear / ridge / lasso / isotonic per label
    "flagship",               # one fit end to end
    "collate_csv",            # season CSV files -> collated table
    "collated_season_scan",   # collated -> Parquet -> pruned season scan
    "typed_cells",
    "labelled_rows",
    "correlation_matrix",
    "components_two",
    "components_norm",
    "regression_metrics",
    "naive_bayes_fit",
    "logistic_fit",
    "svm_fit",
    "multinomial_fit",
    "isotonic_fit",
    "norm_l2",
    "schema_union",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="tablefit-bench",
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("typed_cells")  # warm-up
    times = {}
    for name in HEADLINE:
        times[name] = round(run(name), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
