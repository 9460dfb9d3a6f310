"""Times the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import tables as tb  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from lectern.plans import presets as ps  # noqa: E402
from lectern.plans import runs  # noqa: E402

HEADLINE = (
    "clean_text",
    "dedup_text",
    "clean_meta",
    "labelled_union",
    "csv_sources",
    "length_median",
    "subject_label_pivot",
    "top_words_per_label",
    "vocabulary_table",
    "tfidf_weights",
    "hashing_tf",
    "score_logreg",
    "score_by_lookup",
    "classification_metrics",
    "metrics_at_thresholds",
    "top_errors",
    "importance_spearman",
    "model_comparison",
)


def main(folder: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lectern-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, job) -> None:
        began = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - began, 3)

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timed("session_warm_up", lambda: spark.read.parquet(f"{sf_dir}/documents.parquet").count())
    for name in HEADLINE:
        timed(name, lambda: run(name))
    # The whole job: clean, de-duplicate, features, two linear models, metrics.
    timed("full_linear_run", lambda: runs.train(tb.corpus(spark, sf_dir), ps.LINEAR["full"]))

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="bench-") as written:
        main(written)
