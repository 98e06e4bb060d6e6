import os

from pyspark.sql import functions as F

from recengine.sources import fixtures as X
from recengine.sources import readers, sinks
from tests.conftest import SF


def test_build_samples_job_round_trip(spark):
    import jobs.build_samples as job

    base = sinks.scratch_path(spark, "job")
    sinks.write_csv(X.movies(spark, SF), f"{base}/movies")
    sinks.write_csv(X.ratings(spark, SF).select("userId", "movieId", "rating", "timestamp"), f"{base}/ratings")
    job.main([f"{base}/movies", f"{base}/ratings", f"{base}/out", "--files", "1"], spark=spark)
    train = readers.read_samples(spark, f"{base}/out/split=train")
    test = readers.read_samples(spark, f"{base}/out/split=test")
    assert train.count() > 0 and test.count() > 0
    assert train.join(test, ["userId", "movieId", "timestamp"]).count() == 0
    assert len([f for f in os.listdir(f"{base}/out/split=train".replace("file:", "")) if f.endswith(".csv")]) == 1


def test_train_job_on_written_samples(spark):
    import jobs.build_samples as build
    import jobs.train as train

    from recengine import schemas as S

    base = sinks.scratch_path(spark, "train-job")
    sinks.write_csv(X.movies(spark, SF), f"{base}/movies")
    sinks.write_csv(X.ratings(spark, SF).select("userId", "movieId", "rating", "timestamp"), f"{base}/ratings")
    build.main([f"{base}/movies", f"{base}/ratings", f"{base}/samples", "--fraction", "0.5", "--format", "parquet"],
               spark=spark)
    train.main([f"{base}/samples", f"{base}/out", "--model", "two_tower", "--vocab", ",".join(S.GENRE_VOCAB_TESTDATA),
                "--format", "parquet"], spark=spark)
    row = spark.read.parquet(f"{base}/out/summary").collect()[0]
    assert row["model"] == "two_tower" and 0.0 <= row["roc_auc"] <= 1.0 and 0 < row["log_loss"] < 0.75
    assert spark.read.parquet(f"{base}/out/scores").count() == spark.read.parquet(f"{base}/samples/split=test").count()
    assert spark.read.parquet(f"{base}/out/preview").count() == 12


def test_build_vectors_job(spark):
    import jobs.build_vectors as job

    base = sinks.scratch_path(spark, "vec-job")
    sinks.write_csv(X.ratings(spark, SF).select("userId", "movieId", "rating", "timestamp"), f"{base}/ratings")
    job.main([f"{base}/ratings", f"{base}/out", "--similar-to", "7"], spark=spark)
    assert spark.read.parquet(f"{base}/out/similar_items").count() in (0, 20)
    lines = spark.read.text(f"{base}/out/item2vec").collect()
    assert lines and all(len(r[0].split(":")[1].split(" ")) == 10 for r in lines)
    buckets = spark.read.parquet(f"{base}/out/lsh_buckets")
    assert buckets.count() == len(lines) and len(buckets.first()["buckets"]) == 3
    from pyspark.ml.feature import BucketedRandomProjectionLSHModel

    assert BucketedRandomProjectionLSHModel.load(f"{base}/out/lsh_model").getBucketLength() == 0.1


def test_onehot_job(spark):
    import jobs.onehot_example as job

    base = sinks.scratch_path(spark, "onehot-job")
    sinks.write_csv(X.movies(spark, SF), f"{base}/movies")
    job.main([f"{base}/movies", f"{base}/out"], spark=spark)
    rows = spark.read.parquet(f"{base}/out").collect()
    assert rows and all(r["movieIdVector"].numNonzeros() == 1 for r in rows)
    assert all(r["movieIdVector"][r["movieIdNumber"]] == 1.0 for r in rows)
