"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` set the tables and the cores. Every query is built and run to a
``noop`` sink, so all columns of all rows are produced and none reach the driver. A query's time is the
median of three runs; ``first`` has the first, cold ones. One untimed run of a small query starts the
JVM's code paths. ``--naive`` also times the plain form of the operators
that have one (global windows, one scan per month), for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from catalog import inputs as I  # noqa: E402
from catalog import queries as Q  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = (
    "audience_active trailing_features customer_features customer_scoring_base capped_count_target latest_per_key "
    "star_join training_set evaluation_set global_rank decile percentile_bins train_test_split sample_n undersample "
    "target_encode prep_features score_table_class score_table_regr binned_calibration lift_table eval_table_class "
    "confusion_bins roc_points roc_auc optimal_threshold best_f1 calibration_curve classification_report "
    "regression_metrics spearman score_histogram champion_decision fit_classifier isotonic_levels"
).split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def naive(spark, sf: str) -> dict[str, float]:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidemark.operators.features import trailing_features
    from tidemark.functions import trailing_windows
    from tidemark.operators.features import event_count

    scored = I.scored_orders(spark, sf)
    r = F.row_number().over(Window.orderBy("p0", "id"))

    def windows_apart():
        n = I.notifications(spark, sf)
        tables = [
            trailing_features(n, "customer_id", "event_date", [w], {"shown": event_count(F.col("event_type") == "shown")})
            for w in trailing_windows(I.MONTH)
        ]
        out = tables[0]
        for t in tables[1:]:
            out = out.join(t, "customer_id", "full")
        return out

    plain = {
        "naive_global_rank": lambda: scored.withColumn("rank", r),
        "naive_decile": lambda: scored.withColumn("decile", F.ntile(10).over(Window.orderBy("p0", "id"))),
        "naive_trailing": windows_apart,
    }
    times = {}
    for name, build in plain.items():
        start = time.perf_counter()
        run(build())
        times[name] = round(time.perf_counter() - start, 3)
    return times


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = Q.queries()
    run(known["apply_threshold"](spark, sf))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        if name not in known:
            continue
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            run(known[name](spark, sf))
            runs.append(round(time.perf_counter() - start, 3))
        first[name], times[name] = runs[0], sorted(runs)[1]
    if "--naive" in sys.argv:
        times |= naive(spark, sf)
    total = round(sum(v for k, v in times.items() if not k.startswith("naive")), 3)
    scale = os.path.basename(sf.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "first": first, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
