"""Embedding job: ratings -> per-user positive item sequences -> item2vec -> vector text + LSH buckets.

    spark-submit jobs/build_vectors.py RATINGS OUT [--dim 10] [--partitions N] [--order COLS] [--similar-to ID]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None, spark=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("ratings")
    ap.add_argument("out")
    ap.add_argument("--dim", type=int, default=10)
    ap.add_argument("--part-tokens", type=int, default=None, help="items of the sequences that one training task takes, about")
    ap.add_argument("--order", default="timestamp", help="comma-separated order inside a user; movieId breaks ties")
    ap.add_argument("--similar-to", default=None, help="item whose most similar items and nearest neighbours are written")
    ap.add_argument("--min-count", type=int, default=5, help="items with fewer positive ratings are left out")
    ap.add_argument("--input-format", default="csv")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from recengine.operators import sequences, skipgram, vectors
    from recengine.sources import readers, sinks

    own = spark is None
    spark = spark or SparkSession.builder.appName("build_vectors").getOrCreate()
    ratings = readers.read_ratings(spark, a.ratings, a.input_format)
    seqs = sequences.item_sequences(ratings, order=a.order.split(","), min_count=a.min_count)
    model = skipgram.SkipGram(dim=a.dim, min_count=a.min_count, part_tokens=a.part_tokens or skipgram.PART_TOKENS).fit(seqs)
    vecs = model.vectors()
    sinks.write_item_vectors(vecs, f"{a.out}/item2vec")
    lsh, df = vectors.lsh_model(vecs.select(F.col("word").alias("id"), "vector"))
    vectors.lsh_buckets(lsh, df).write.mode("overwrite").parquet(f"{a.out}/lsh_buckets")
    lsh.write().overwrite().save(f"{a.out}/lsh_model")
    if a.similar_to:
        model.synonyms(a.similar_to).write.mode("overwrite").parquet(f"{a.out}/similar_items")
        probe = vecs.where(F.col("word") == a.similar_to).select("vector").first()
        if probe:
            near = vectors.lsh_nearest(lsh, df, list(probe[0]))
            near.write.mode("overwrite").parquet(f"{a.out}/neighbours")
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
