"""Null, zero and one-class cases; bad cells; joins on keys that repeat or are null; tied orders."""

import pytest
from pyspark.sql import functions as F

from recengine.functions.columns import id_bucket
from recengine.operators import metrics as MT
from recengine.operators import vectors as V
from recengine.plans.samples import build_samples
from recengine.sources import fixtures as X
from recengine.sources import readers, sinks
from tests.conftest import SF

VECTORS = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 1e-9]), (5, [-1.0, 0.0]), (6, [1.0])]


def vectors(spark):
    return spark.createDataFrame(VECTORS, "id long, vector array<double>")


def test_zero_and_null_vectors(spark):
    similar = V.top_k_similar(vectors(spark).where("id != 6"), 1).collect()
    assert [r["id"] for r in similar] == [4, 5]
    assert V.top_k_similar(vectors(spark).where("id != 6"), 2).collect() == []
    near = V.k_nearest(vectors(spark), [1.0, 0.0], k=10).collect()
    assert [r["id"] for r in near] == [1, 4, 2, 5]


def test_ranked_by_the_full_value(spark):
    v = spark.createDataFrame([(1, [2e-9]), (2, [1e-9]), (3, [0.0])], "id long, vector array<double>")
    assert [r["id"] for r in V.k_nearest(v, [0.0], k=3).collect()] == [3, 2, 1]


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_has_no_area(spark, label):
    df = spark.createDataFrame([(0.2, label), (0.7, label)], "p double, label int")
    row = MT.summary(df).first()
    assert row["roc_auc"] is None and row["log_loss"] is not None
    assert MT.summary(df.limit(0)).first()["accuracy"] is None


def test_many_buckets_agree(spark):
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("p"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    assert MT.summary(df, buckets=150).first() == MT.summary(df, buckets=1).first()


def test_history_lookup_with_repeated_and_null_keys(spark):
    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 6)], "id long, vector array<double>")
    rows = [(1, 1, 2), (1, 1, 2), (1, 3, None), (None, 4, 5), (None, None, None), (2, 9, 1)]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    small = V.history_lookup(df, table, ["a", "b"], 2)
    large = V.history_lookup(df, table, ["a", "b"], 2, max_broadcast_rows=1)
    assert small.count() == len(rows) and small.columns == large.columns
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert {len(r["history_vectors"]) for r in large.collect()} == {2}


def test_ids_outside_a_column_are_an_error_if_asked(spark):
    df = spark.createDataFrame([(3,), (None,), (12,)], "k long")
    assert [r[0] for r in df.select(id_bucket("k", 10)).collect()] == [3, None, None]
    assert [r[0] for r in df.where("k is null or k < 10").select(id_bucket("k", 10, "error")).collect()] == [3, None]
    with pytest.raises(Exception, match="id outside"):
        df.select(id_bucket("k", 10, "error")).collect()


def test_bad_cells_keep_their_rows(spark):
    path = sinks.scratch_path(spark, "bad-ratings")
    spark.createDataFrame([("userId,movieId,rating,timestamp",), ("1,2,3.5,4",), ("1,2,x,4",), ("1,2,3.5,y",), ("1,3,4.0,9",)],
                          "value string").coalesce(1).write.text(path)
    df = readers.read_ratings(spark, path)
    assert df.count() == len(df.collect()) == 4
    assert {r["movieId"]: r["count"] for r in df.groupBy("movieId").count().collect()} == {2: 3, 3: 1}
    assert df.where("rating is null").count() == 1 and df.where("timestamp is null").count() == 1


def test_malformed_samples_are_skipped_whatever_is_read(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    path = sinks.scratch_path(spark, "bad-samples")
    spark.createDataFrame([("a,b,c",), ("1,x,2.5",), ("?,x,2.5",), ("2,0,",), ("3,y,bad",)], "value string").coalesce(1).write.text(path)
    df = readers.read_samples(spark, path, schema)
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "x", 2.5), (2, "", None)]
    assert df.count() == 2 and df.select("b").count() == 2
    table = sinks.scratch_path(spark, "samples-table")
    df.write.parquet(table)
    assert readers.read_samples(spark, table, schema, fmt="parquet").count() == 2


def test_input_layout_and_hot_split_change_nothing_with_ties(spark):
    """Day-granular timestamps tie inside a user; movieId and rating break the ties."""
    ratings = X.ratings(spark, SF).select("userId", "movieId", "rating", "timestamp")
    movies = X.movies(spark, SF)
    plain = build_samples(ratings, movies)
    other = build_samples(ratings.repartition(7, "rating"), movies)
    hot = build_samples(ratings.repartition(3), movies, hot_threshold=60)
    assert plain.exceptAll(other).count() == 0 and plain.count() == other.count()
    assert plain.exceptAll(hot).count() == 0 and plain.count() == hot.count()


def test_merging_files_leaves_the_work_parallel(spark):
    df = spark.range(1000).repartition(8).withColumn("split", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    path = sinks.scratch_path(spark, "merged")
    out = sinks.write_train_test(df, path, num_files=1)
    assert spark.read.option("header", True).csv(out["train"]).count() == 800
    assert "Coalesce" not in df.repartition(1)._jdf.queryExecution().executedPlan().toString()
