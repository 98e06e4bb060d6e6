"""The movie table's way into the sample: broadcast by its measured bytes, else by one shuffle join; the same rows."""

from pyspark.sql import functions as F

from recengine.operators import joins, users
from recengine.operators.labels import add_label
from recengine.operators.movies import movie_table
from recengine.plans import features as FT
from recengine.plans import samples as P
from tests.conftest import SF

MOVIES = [(10 + i, f"Movie {i} ({1950 + i})", ["Drama", "Comedy|War", "War|Drama|Action"][i % 3]) for i in range(12)]


def tables(spark):
    rows = [(u, 10 + (i * 5 + u) % 12, 0.5 + (i * 7 + u) % 10 * 0.5, 100 + i) for u in range(6) for i in range(30)]
    rated = add_label(spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long"))
    return rated, movie_table(rated, spark.createDataFrame(MOVIES, "movieId long, title string, genres string"))


def shuffle_joins(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin")


def test_broadcast_is_decided_by_bytes_and_changes_no_row(spark):
    rated, table = tables(spark)
    near = users.sample_features(rated, table)
    assert shuffle_joins(near) == 0
    far = users.sample_features(rated, table, max_broadcast_bytes=10)
    assert near.columns == far.columns and near.count() == far.count() > 0
    assert near.exceptAll(far).count() == 0 and far.exceptAll(near).count() == 0


def test_table_bytes_grow_with_rows_and_texts(spark):
    df = spark.createDataFrame([(1, "a" * 100), (2, None)], "k long, t string")
    assert joins.table_bytes(df) == 2 * (8 * 2 + 24) + 108 + 8
    assert joins.table_bytes(df.where("k > 5")) == 0


def test_sizes_of_the_ids_come_from_the_counts(spark, monkeypatch):
    from recengine.operators import encoders as E
    from recengine.sources import fixtures as X

    rated = P.labeled(spark, SF)
    assert E.id_sizes(P.rating_counts(rated)) == E.id_sizes(X.ratings(spark, SF))
    calls = []
    real = X.ratings
    monkeypatch.setattr(X, "ratings", lambda *a: calls.append(a) or real(*a))
    assert FT.encoded(spark, SF).agg(F.count("movieBucket")).first()[0] > 0
    assert len(calls) == 2  # for the counts and for the sample
