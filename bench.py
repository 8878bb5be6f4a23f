"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillcast.operators import rolling, split
from tillcast.operators.features import EXCLUDED
from tillcast.plans import queries as registered
from tillcast.plans import train as training
from tillcast.session import local_session
from tillcast.sources.panel import calendar_bounds, join_store, store_attributes, store_panel

HEADLINE = [
    "panel_daily",
    "days_since_events",
    "days_around_refurb",
    "holiday_week_counts",
    "trend_yoy",
    "trend_ridge_q",
    "trend_ridge_y",
    "describe_sales_by_type",
    "ecdf_sales",
    "corr_lower_triangle",
    "best_pairs",
    "score_comparison",
    "submission",
]


def fit_five_rounds(spark, folder: str) -> float:
    """One training step: text codes, vectors, five boosting rounds and the holdout score."""
    rows = join_store(store_panel(spark, folder), store_attributes(spark, folder))
    train, holdout = split.time_split(rows, last_day=calendar_bounds(spark, folder)[1])
    candidates = [c for c in rows.columns if c not in EXCLUDED]
    matrix = training.fit_matrix(train, candidates)
    fit_rows, check_rows = (training.labelled(matrix, df) for df in (train, holdout))
    return training.fit_trees(matrix, fit_rows, check_rows, candidates, training.TreeParams(rounds=5)).rmspe


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=2 * cores)
    spark.sparkContext.setLogLevel("ERROR")
    run = registered.REGISTRY
    plans = {name: (lambda name=name: run[name](spark, folder)) for name in HEADLINE}
    # All 144 rolling features over the dense supplier panel.
    plans["recent_144"] = lambda: rolling.add_recent_features(store_panel(spark, folder))
    seconds = {}
    store_panel(spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    for name, plan in plans.items():
        start = time.time()
        plan().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    start = time.time()
    fit_five_rounds(spark, folder)
    seconds["fit_five_rounds"] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
