"""Benchmark of the headline queries: prints one JSON line.

Every query is run to completion over all of its rows, without bringing them to the driver. The first run of
the session only warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codeloom.catalog import REGISTRY, Tables
from codeloom.session import local_session

HEADLINE = ("dict_build_multi", "dict_cascade", "soc_dict_build", "soc_dict_lookup", "fuzzy_match", "fill_missing_codes", "decision_log",
            "topk_proba", "max_merge", "macro_f1", "knn_topk", "knn_vote", "fuse_candidates", "tfidf_word", "clf_complement_nb", "predict_flat")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["scan_survey"].run(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.time()
        REGISTRY[name].run(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
