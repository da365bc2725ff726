"""Benchmark: run the headline queries on $BENCH_SF_DIR and print one JSON line.

Each query is executed to completion with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "marker_rates", "numeric_summary", "categorical_summary", "binary_metrics_li", "binary_metrics_ev",
    "calibration_ev", "precision_recall_at_k_li", "global_top_k_li", "map_by_group_li", "split_summary",
    "tfidf_vocab", "tfidf_doc_stats", "column_profile", "scaler_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ranklift.session import get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    from ranklift.plans import catalog
    catalog.load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in catalog.QUERIES]
    times = {}
    for n in names:
        t0 = time.perf_counter()
        catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
