"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from recensio import catalog
from recensio.session import local_session, release

HEADLINE = [
    "t01_clean_text",
    "f09_is_rule_outlier",
    "x15_rare_token_ratio",
    "x16_token_entropy",
    "a03_describe",
    "a10_label_counts",
    "a14_monthly_label_counts",
    "d02_remove_duplicates",
    "j05b_similar_vectors_092",
    "n01_detect_language",
    "n02_translate",
    "n07_ensemble_sentiment",
    "m03_density_cluster",
    "m05_class_tfidf",
    "m09_silhouette",
    "m10_match_taxonomy",
    "w01_later_copies",
    "flow_top_negative_labels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=8 if cores == "*" else max(8, int(cores)), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    registered = catalog.queries()
    for name in HEADLINE:
        started = time.time()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        release(spark)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
