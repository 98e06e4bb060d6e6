"""One-hot example: movies -> movie id one-hot vectors (last category kept), written as parquet.

    spark-submit jobs/onehot_example.py MOVIES OUT
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None, spark=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("movies")
    ap.add_argument("out")
    ap.add_argument("--input-format", default="csv")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from recengine.operators.encoders import onehot_ids
    from recengine.sources import readers

    own = spark is None
    spark = spark or SparkSession.builder.appName("onehot_example").getOrCreate()
    out, _ = onehot_ids(readers.read_movies(spark, a.movies, a.input_format))
    out.write.mode("overwrite").parquet(a.out)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
