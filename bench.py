"""Headline-query benchmark.

Runs the headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line. Each query is fully materialised with the ``noop`` sink (every row is
computed, nothing is collected); the time is the median of $BENCH_REPEAT runs (default 3) after
one warm-up run that is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["rating_histogram", "movie_features", "user_features", "item_sequences", "eval_summary", "item2vec",
            "csv_samples_sink", "lsh_nearest"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    from recengine.session import get_session

    spark = get_session(master=f"local[{cpus}]", app="recengine-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.ui.showConsoleProgress": "false",
                               "spark.local.dir": tempfile.mkdtemp(prefix="recengine-bench-")})
    from recengine.plans import training
    from recengine.plans.catalog import QUERIES

    times = {}
    for name in names:
        runs = []
        for i in range(repeat + 1):
            training.forget_models()  # every run fits anew
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
