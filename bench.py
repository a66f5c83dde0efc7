"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is materialised with a no-op write (``format("noop")``) so the
whole plan runs without collecting rows to the driver; the median of
``BENCH_REPEAT`` runs (default 3) is reported after one warm-up of the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import queries as Q  # noqa: E402
from quarry.session import get_session  # noqa: E402

HEADLINE = ["feat_all", "feat_expanding", "feat_window_counts", "feat_window_values", "asof_label_join", "asof_available_labels",
            "average_precision", "evaluate_model", "stratified_split", "stable_split", "batch_score",
            "online_latest", "dataset_digest", "monitor_performance", "feat_p95_flag", "impute_median",
            "impute_mode", "category_vocab", "one_hot", "feature_matrix", "feature_profile",
            "champion_challenger_eval", "promotion_decision", "audit_trail", "feat_last_k_sum", "gbt_train_score"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, codegen caches, file listing
    Q.feat_expanding(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
