"""Skew experiment: one user holds a third of all ratings. Runs the flagship plainly (that user
in one task) and with hot-user splitting, checks the rows are identical, prints timings.

    python tools/skew_experiment.py /root/testdata/sf0.1 50000 [chunk_rows]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark.sql import functions as F

    from recengine import schemas as S
    from recengine.operators.labels import add_label
    from recengine.operators.movies import add_movie_features
    from recengine.operators.ordering import hot_keys
    from recengine.operators.users import add_user_features
    from recengine.session import get_session
    from recengine.sources import fixtures

    sf, threshold = sys.argv[1], int(sys.argv[2])
    chunk = int(sys.argv[3]) if len(sys.argv) > 3 else None
    spark = get_session(shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    r = fixtures.ratings(spark, sf)
    # every third order belongs to user -1: a third of all rows in one key
    skewed = add_label(r.withColumn("userId", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("userId"))))
    samples = add_movie_features(skewed, fixtures.movies(spark, sf))
    keep = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    out = {}
    frames = {}
    runs = [("split", threshold)] if os.environ.get("SPLIT_ONLY") else [("plain", 10 ** 12), ("split", threshold)]
    for name, thr in runs:
        t0 = time.perf_counter()
        hot = hot_keys(skewed.select("userId"), "userId", thr)
        df = add_user_features(samples, order=S.TESTDATA_ORDER, keep=keep, hot_threshold=thr, hot=hot,
                               chunk_rows=chunk if name == "split" else None)
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 2)
        frames[name] = df
    out["hot_rows"] = skewed.where("userId = -1").count()
    if "plain" in frames:
        a, b = frames["plain"], frames["split"]
        out["rows"] = a.count()
        out["differing_rows"] = a.exceptAll(b).count() + b.exceptAll(a).count()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
