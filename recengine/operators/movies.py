"""Movie features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.functions.columns import genre_slot, release_year, two_decimals
from recengine.operators.joins import DEFAULT_BROADCAST_ROWS, join_dimension
from recengine.session import reliable_checkpoint


def with_release_year(movies: DataFrame, title: str = "title") -> DataFrame:
    return movies.withColumn("releaseYear", release_year(title))


def with_genre_slots(df: DataFrame, genres: str = "genres", slots: int = S.MOVIE_GENRE_SLOTS) -> DataFrame:
    return df.select("*", *[genre_slot(genres, i).alias(f"movieGenre{i + 1}") for i in range(slots)])


def movie_attributes(movies: DataFrame) -> DataFrame:
    """Per movie: title, genres, release year and genre slots — computed once per movie, before the
    join, so the fact table only carries the results."""
    m = movies.select("movieId", "title", "genres", release_year("title").alias("releaseYear"),
                      *[genre_slot("genres", i).alias(f"movieGenre{i + 1}") for i in range(S.MOVIE_GENRE_SLOTS)])
    return m


def movie_rating_stats(ratings: DataFrame) -> DataFrame:
    """Per movie: rating count, average and sample stddev (0 when undefined) as two-decimal text.

    Grouped from the ratings alone (partial aggregation per task, so a heavily rated movie is
    combined map-side before the shuffle).
    """
    g = ratings.groupBy("movieId").agg(*rating_stat_aggregates())
    return format_rating_stats(g)


def rating_stat_aggregates() -> list:
    """count / avg / sample stddev of ``rating`` as ``_n``, ``_avg``, ``_std``."""
    return [F.count(F.lit(1)).alias("_n"), F.avg("rating").alias("_avg"), F.stddev_samp("rating").alias("_std")]


def format_rating_stats(g: DataFrame) -> DataFrame:
    """(movieId, _n, _avg, _std) -> the published statistics columns."""
    return g.select(
        "movieId", F.col("_n").alias("movieRatingCount"),
        two_decimals("_avg").alias("movieAvgRating"),
        two_decimals(F.coalesce(F.col("_std"), F.lit(0.0))).alias("movieRatingStddev"))


def join_movies(ratings: DataFrame, movies: DataFrame,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """ratings LEFT JOIN movie attributes on movieId (J1 + P3 + P4)."""
    out = join_dimension(ratings, movie_attributes(movies), "movieId", "left", max_broadcast_rows)
    # a missing movie still gets the default year (the reference's year rule maps null to 1990)
    return out.withColumn("releaseYear", F.coalesce(F.col("releaseYear"), F.lit(S.DEFAULT_RELEASE_YEAR)))


def movie_table(labeled: DataFrame, movies: DataFrame, stats: DataFrame | None = None,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, pin: bool = True) -> DataFrame:
    """One row per rated movie: rating statistics and attributes, so that the ratings are joined once.

    With ``pin`` it is written once (reliable checkpoint): its real size then decides the broadcast
    without running the aggregation a second time. ``stats`` may be given by the caller (e.g. from a
    shared grouping-sets pass).
    """
    stats = movie_rating_stats(labeled) if stats is None else stats
    table = join_dimension(stats, movie_attributes(movies), "movieId", "left", max_broadcast_rows)
    table = table.withColumn("releaseYear", F.coalesce(F.col("releaseYear"), F.lit(S.DEFAULT_RELEASE_YEAR)))
    return reliable_checkpoint(table) if pin else table


def add_movie_features(labeled: DataFrame, movies: DataFrame,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, pin_stats: bool = True,
                       stats: DataFrame | None = None, table: DataFrame | None = None) -> DataFrame:
    """Labelled ratings + movie attributes + per-movie rating statistics (J2): one join on movieId."""
    table = movie_table(labeled, movies, stats, max_broadcast_rows, pin_stats) if table is None else table
    out = join_dimension(labeled, table, "movieId", "left", max_broadcast_rows)
    return fill_movie_columns(out)


def fill_movie_columns(df: DataFrame) -> DataFrame:
    """A rating without a movie gets the default year and a count of 0."""
    fill = {"releaseYear": S.DEFAULT_RELEASE_YEAR, "movieRatingCount": 0}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)).cast(df.schema[c].dataType) for c, v in fill.items()
                           if c in df.columns})
