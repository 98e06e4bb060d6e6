"""The sample-building job as composable steps: label -> movie features -> user features -> split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.operators.labels import add_label
from recengine.operators.movies import add_movie_features, format_rating_stats, movie_table, rating_stat_aggregates
from recengine.operators.ordering import DEFAULT_HOT_ROWS, hot_keys_from_counts
from recengine.session import reliable_checkpoint
from recengine.operators.users import sample_features
from recengine.sources import fixtures

TIEBREAK = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_label(fixtures.ratings(spark, sf_dir))


def movie_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_movie_features(labeled(spark, sf_dir), fixtures.movies(spark, sf_dir))


def user_features(spark: SparkSession, sf_dir: str, keep_tiebreak: bool = False,
                  hot_threshold: int = DEFAULT_HOT_ROWS, chunk_rows: int | None = None,
                  counts: DataFrame | None = None) -> DataFrame:
    """The flagship 28-column sample over the driver tables; ``counts``: :func:`rating_counts` of its ratings, if there."""
    rated = labeled(spark, sf_dir)
    hot, stats = prepare(rated, hot_threshold, counts)
    table = movie_table(rated, fixtures.movies(spark, sf_dir), stats)
    return sample_features(rated, table, order=S.TESTDATA_ORDER, keep=TIEBREAK if keep_tiebreak else None,
                           hot_threshold=hot_threshold, chunk_rows=chunk_rows, hot=hot)


def rating_counts(rated: DataFrame) -> DataFrame:
    """Ratings by user and by movie from ONE scan: grouping sets (userId) and (movieId), partially aggregated
    per task, written once. The largest ids are in it, too."""
    g = rated.groupingSets([["userId"], ["movieId"]], "userId", "movieId").agg(
        F.grouping_id().alias("_gid"), *rating_stat_aggregates())
    return reliable_checkpoint(g)


def prepare(rated: DataFrame, hot_threshold: int = DEFAULT_HOT_ROWS, counts: DataFrame | None = None):
    """Rows per user (for the hot-user split) and per-movie rating statistics from :func:`rating_counts`.
    The left joins to movies keep the rows per user, so counting the plain ratings is exact."""
    g = rating_counts(rated) if counts is None else counts
    # grouping_id: bit set for the column NOT grouped -> (userId) set = 1, (movieId) set = 2
    hot = hot_keys_from_counts(g.where(F.col("_gid") == 1).select("userId", "_n"), "userId", hot_threshold)
    stats = format_rating_stats(g.where(F.col("_gid") == 2).select("movieId", "_n", "_avg", "_std"))
    return hot, stats


def build_samples(ratings: DataFrame, movies: DataFrame, order: list[str] | None = None,
                  hot_threshold: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Generic form for any typed ratings/movies pair (CSV or table)."""
    rated = add_label(ratings)
    hot, stats = prepare(rated, hot_threshold)
    return sample_features(rated, movie_table(rated, movies, stats), order=order, hot_threshold=hot_threshold, hot=hot)
