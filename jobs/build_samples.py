"""Feature job: ratings + movies -> labelled, leak-free feature sample -> 10 % sample -> train/test.

    spark-submit jobs/build_samples.py MOVIES RATINGS OUT [--format csv|parquet] [--files N] [--order COLS]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None, spark=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("movies")
    ap.add_argument("ratings")
    ap.add_argument("out")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--files", type=int, default=None, help="deal the finished rows of each part out to N files")
    ap.add_argument("--order", default="timestamp", help="comma-separated order inside a user; movieId and rating break ties")
    ap.add_argument("--fraction", type=float, default=0.1)
    ap.add_argument("--input-format", default="csv")
    ap.add_argument("--hot-rows", type=int, default=None, help="users above this many ratings are split")
    ap.add_argument("--quarantine", default=None, help="folder for bad CSV lines; without it bad cells are null")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from recengine import schemas
    from recengine.operators.split import hash_sample, train_test_split
    from recengine.plans.samples import build_samples
    from recengine.sources import readers, sinks

    own = spark is None
    spark = spark or SparkSession.builder.appName("build_samples").getOrCreate()
    if a.quarantine and a.input_format == "csv":
        (movies, few), (ratings, many) = (readers.read_quarantined(spark, path, schema, f"{a.quarantine}/{name}") for name, path, schema in (
            ("movies", a.movies, schemas.MOVIES), ("ratings", a.ratings, schemas.RATINGS)))
        counts = few.withColumn("table", F.lit("movies")).unionByName(many.withColumn("table", F.lit("ratings")))
        counts.write.mode("overwrite").parquet(f"{a.quarantine}/counts")
    else:
        movies = readers.read_movies(spark, a.movies, a.input_format)
        ratings = readers.read_ratings(spark, a.ratings, a.input_format)
    key = ["userId", "movieId", "timestamp"]
    kw = {"hot_threshold": a.hot_rows} if a.hot_rows else {}
    kw["order"] = a.order.split(",")
    samples = train_test_split(hash_sample(build_samples(ratings, movies, **kw), key, a.fraction), key)
    sinks.write_train_test(samples, a.out, num_files=a.files, fmt=a.format)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
