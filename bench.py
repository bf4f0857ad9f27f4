"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table directory, BENCH_CPUS the number of local cores.
Every query is computed in full and its rows are thrown away.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from holdfast.catalog.queries import registered_queries
from holdfast.session import session

HEADLINE = [
    "content_list",
    "top_shows",
    "churn_labels",
    "churn_labels_window",
    "features",
    "time_split",
    "score_describe",
    "auc_roc",
    "threshold_metrics",
    "model_metrics",
    "daily_scores",
    "campaign_brief",
    "final_copy_prompt",
    "messages",
    "delivery_list",
    "outbox_rows",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "holdfast-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered_queries()
    spark.read.parquet(f"{directory}/events.parquet").count()  # start the session
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline queries, total wall-clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": pyspark.__version__,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
