from pyspark.sql import functions as F

from recengine.operators.labels import add_label
from recengine.operators.movies import add_movie_features
from recengine.operators.users import add_user_features

MOVIES = [(10, "A (1990)", "Action|Drama"), (11, "B (2000)", "Drama"), (12, "C (2010)", "Comedy|Action"),
          (13, "D (1980)", "Drama|Comedy")]


def run(spark, ratings, **kw):
    r = spark.createDataFrame(ratings, "userId long, movieId long, rating double, timestamp long")
    m = spark.createDataFrame(MOVIES, "movieId long, title string, genres string")
    return add_user_features(add_movie_features(add_label(r), m), **kw)


def test_history_newest_first_and_count(spark):
    # a, b, c, d with labels 1, 0, 1, 1
    rows = [(1, 10, 4.0, 100), (1, 11, 1.0, 200), (1, 12, 5.0, 300), (1, 13, 4.5, 400)]
    out = {r["movieId"]: r for r in run(spark, rows).collect()}
    d = out[13]
    assert [d["userRatedMovie1"], d["userRatedMovie2"], d["userRatedMovie3"]] == [12, 10, None]
    assert d["userRatingCount"] == 3
    assert set(out) == {12, 13}  # first two ratings have < 2 prior ratings


def test_short_users(spark):
    rows = [(1, 10, 4.0, 1)] + [(2, 10, 4.0, 1), (2, 11, 4.0, 2)] + [(3, 10, 4.0, 1), (3, 11, 4.0, 2), (3, 12, 4.0, 3)]
    counts = {r["userId"]: r["n"] for r in run(spark, rows).groupBy("userId").agg(F.count("*").alias("n")).collect()}
    assert counts == {3: 1}


def test_long_user_saturates(spark):
    rows = [(7, 10 + (i % 4), 4.0, 1000 + i) for i in range(150)]
    mx = run(spark, rows).agg(F.max("userRatingCount")).collect()[0][0]
    assert mx == 100


def test_numeric_timestamp_order(spark):
    rows = [(1, 10, 4.0, 1100000000), (1, 11, 4.0, 978300000), (1, 12, 4.0, 1200000000)]
    r = run(spark, rows).collect()[0]
    assert r["movieId"] == 12 and r["userRatedMovie1"] == 10 and r["userRatedMovie2"] == 11


def test_genre_ties_alphabetical(spark):
    rows = [(1, 11, 4.0, 1), (1, 12, 4.0, 2), (1, 10, 1.0, 3)]
    r = run(spark, rows).collect()[0]
    # liked: Drama (B), Comedy|Action (C): Action 1, Comedy 1, Drama 1 -> alphabetical
    assert [r["userGenre1"], r["userGenre2"], r["userGenre3"], r["userGenre4"]] == ["Action", "Comedy", "Drama", None]


def test_no_leakage(spark):
    base = [(1, 10 + (i % 4), 1.0 + (i % 9) * 0.5, 10 * i) for i in range(40)]
    changed = list(base)
    changed[30] = (1, 13, 5.0, 300)
    a = run(spark, base).where("timestamp <= 300").orderBy("timestamp").drop("rating", "label", "movieId").collect()
    b = run(spark, changed).where("timestamp <= 300").orderBy("timestamp").drop("rating", "label", "movieId").collect()
    # rows up to and including the changed one keep their user features
    ua = [r.asDict() for r in a]
    ub = [r.asDict() for r in b]
    keep = [k for k in ua[0] if k.startswith("user")]
    assert [{k: x[k] for k in keep} for x in ua] == [{k: x[k] for k in keep} for x in ub]


def test_hot_user_split_is_exact(spark):
    rows = [(u, 10 + (i * 7 + u) % 4, 0.5 + ((i * 3 + u) % 10) * 0.5, 1000 + i // 3 * 10)
            for u in (1, 2, 3) for i in range(60 * u)]
    order = ["timestamp", "movieId", "rating"]
    rows = list({(u, m, r, t): None for (u, m, r, t) in rows})  # unique order key per user
    plain = run(spark, rows, order=order)
    for chunk in (7, 25, 200):
        hot = run(spark, rows, order=order, hot_threshold=50, chunk_rows=chunk)
        assert plain.count() == hot.count()
        assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_many_hot_keys_use_frame_path(spark, monkeypatch):
    from recengine.operators import ordering

    monkeypatch.setattr(ordering, "MAX_HOT_LITERALS", 1)
    rows = [(u, 10 + (i * 5 + u) % 4, 0.5 + ((i * 7 + u) % 10) * 0.5, 100 + i * 10)
            for u in (1, 2, 3, 4) for i in range(40 + 10 * u)]
    order = ["timestamp", "movieId", "rating"]
    plain = run(spark, rows, order=order)
    hot = run(spark, rows, order=order, hot_threshold=45, chunk_rows=20)
    h = ordering.hot_keys(spark.createDataFrame([(r[0],) for r in rows], "userId long"), "userId", 45)
    assert h.values is None and h.rows == sum(40 + 10 * u for u in (1, 2, 3, 4) if 40 + 10 * u > 45)
    assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_single_rating_movie_stddev_is_zero_text(spark):
    from recengine.operators.movies import movie_rating_stats

    r = spark.createDataFrame([(1, 10, 4.0, 1), (2, 11, 3.0, 1), (3, 11, 4.0, 2)],
                              "userId long, movieId long, rating double, timestamp long")
    got = {x["movieId"]: (x["movieRatingCount"], x["movieAvgRating"], x["movieRatingStddev"])
           for x in movie_rating_stats(r).collect()}
    assert got[10] == (1, "4.00", "0.00") and got[11] == (2, "3.50", "0.71")


def test_group_positions_dense_inside_skewed_group(spark):
    from recengine.operators.ordering import group_positions

    rows = [(1, t, k) for t in range(300) for k in range(3)] + [(2, t, 0) for t in range(7)]
    df = spark.createDataFrame(rows, "u long, t long, k long").repartition(5)
    pos = group_positions(df, "u", ["t", "k"], total_rows=len(rows), rows_per_partition=100)
    got = {(r["u"], r["t"], r["k"]): r["_pos"] for r in pos.collect()}
    assert [got[(1, t, k)] for t in range(300) for k in range(3)] == list(range(900))
    assert [got[(2, t, 0)] for t in range(7)] == list(range(7))


def test_input_partitioning_changes_nothing(spark):
    rows = [(u, 10 + (i * 3 + u) % 4, 0.5 + ((i * 7 + u) % 10) * 0.5, 50 + i * 10) for u in range(1, 8) for i in range(30)]
    r = spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    m = spark.createDataFrame(MOVIES, "movieId long, title string, genres string")
    a = add_user_features(add_movie_features(add_label(r), m))
    b = add_user_features(add_movie_features(add_label(r.repartition(7, "rating").sortWithinPartitions("movieId")), m))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_flagship_hot_path_on_driver_tables(spark):
    from recengine.plans import samples as P
    from tests.conftest import SF

    plain = P.user_features(spark, SF, keep_tiebreak=True)
    hot = P.user_features(spark, SF, keep_tiebreak=True, hot_threshold=30, chunk_rows=9)
    assert plain.count() == hot.count() == 5700
    assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_null_user_group_can_be_hot(spark):
    rows = [(None if i % 3 == 0 else 1 + i % 4, 10 + i % 4, 0.5 + (i % 10) * 0.5, 100 + i) for i in range(240)]
    order = ["timestamp"]
    plain = run(spark, rows, order=order)
    hot = run(spark, rows, order=order, hot_threshold=50, chunk_rows=30)
    assert plain.where("userId is null").count() == 78
    assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_all_negative_user_has_empty_history(spark):
    rows = [(5, 10 + i % 4, 1.0, 100 + i) for i in range(6)]
    out = run(spark, rows).collect()
    assert len(out) == 4
    assert all(r["userRatedMovie1"] is None and r["userGenre1"] is None for r in out)
    assert all(r["userAvgRating"] == "1.00" and r["userRatingStddev"] == "0.00" for r in out)


def test_equal_timestamps_broken_by_caller_column(spark):
    r = spark.createDataFrame([(1, 10, 4.0, 5, 2), (1, 11, 4.0, 5, 1), (1, 12, 4.0, 5, 3), (1, 13, 4.0, 9, 0)],
                              "userId long, movieId long, rating double, timestamp long, seq int")
    m = spark.createDataFrame(MOVIES, "movieId long, title string, genres string")
    out = {x["movieId"]: x for x in add_user_features(add_movie_features(add_label(r), m),
                                                      order=["timestamp", "seq"]).collect()}
    # order: 11 (seq 1), 10 (seq 2), 12 (seq 3), 13
    assert set(out) == {12, 13}
    assert [out[13]["userRatedMovie1"], out[13]["userRatedMovie2"], out[13]["userRatedMovie3"]] == [12, 10, 11]
