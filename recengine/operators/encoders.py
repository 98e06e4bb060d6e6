"""Feature encoders (K1, K5-K10, P8): identity buckets, vocabulary indices, indicators, hashed
crosses, numeric columns and the assembled dense input. All are Column expressions or spark.ml
transformers; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.functions.columns import id_bucket, md5_bucket, parse_number, vocab_index

NUMERIC_FEATURES = ["movieAvgRating", "movieRatingStddev", "movieRatingCount", "userAvgRating",
                    "userRatingStddev", "userRatingCount", "releaseYear"]
HISTORY_COLS = [f"userRatedMovie{i}" for i in range(1, S.HISTORY_SLOTS + 1)]
GENRE_COLS = [f"movieGenre{i}" for i in range(1, 4)] + [f"userGenre{i}" for i in range(1, 6)]


def onehot_ids(df: DataFrame, id_col: str = "movieId", out_col: str = "movieIdVector"):
    """Reference one-hot example: id text -> int -> sparse one-hot, last category kept.
    Returns (frame with ``movieIdNumber`` and the vector, fitted model). Size = max id + 1."""
    num = df.withColumn("movieIdNumber", F.col(id_col).cast("string").try_cast("int"))
    enc = OneHotEncoder(inputCols=["movieIdNumber"], outputCols=[out_col], dropLast=False)
    model = enc.fit(num)
    return model.transform(num), model


def id_sizes(df: DataFrame) -> tuple[int, int]:
    """(movie, user) identity column sizes that hold every id of the rows: largest id + 1."""
    movie, user = df.agg(F.max("movieId"), F.max("userId")).first()
    return int(movie if movie is not None else -1) + 1, int(user if user is not None else -1) + 1


def with_id_buckets(df: DataFrame, movie_ids: int = S.MOVIE_ID_BUCKETS, user_ids: int = S.USER_ID_BUCKETS,
                    on_invalid: str = "null") -> DataFrame:
    return df.select("*",
                     id_bucket("movieId", movie_ids, on_invalid).alias("movieBucket"),
                     id_bucket("userId", user_ids, on_invalid).alias("userBucket"),
                     id_bucket("userRatedMovie1", movie_ids, on_invalid).alias("ratedMovieBucket"))


def with_vocab_indices(df: DataFrame, vocabulary: list[str], cols: list[str] = GENRE_COLS) -> DataFrame:
    return df.select("*", *[vocab_index(c, vocabulary).alias(f"{c}Index") for c in cols])


def indicator(index_col, size: int):
    """0/1 array of ``size`` with a 1 at the index; an index outside [0, size) gives all zeros."""
    idx = F.col(index_col) if isinstance(index_col, str) else index_col
    at = idx.cast("int")
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    return F.when((idx >= 0) & (idx < size), F.concat(zeros(at), F.array(F.lit(1.0)), zeros(F.lit(size - 1) - at))).otherwise(zeros(size))


def active_indices(arr):
    """Positions of the non-zero entries of an array (the sparse view of an indicator)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_compact(F.transform(a, lambda x, j: F.when(x != 0, j)))  # the array is built once, not for each position


def crossed_bucket(a, b, n: int = S.CROSS_BUCKETS):
    """Hashed cross of two categorical ids into n buckets; null when either side is missing."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.when(ca.isNotNull() & cb.isNotNull(), md5_bucket([ca, cb], n))


def numeric_array(cols: list[str] = NUMERIC_FEATURES):
    """Numeric inputs as one double array; formatted texts are parsed, missing values are 0."""
    parts = []
    for c in cols:
        parts.append(F.coalesce(parse_number(c) if c.endswith(("Rating", "Stddev")) else F.col(c).cast("double"),
                                F.lit(0.0)))
    return F.array(*parts)


def history_ids(cols: list[str] = HISTORY_COLS):
    """History slots with default 0 for missing."""
    return F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in cols])


def assemble(df: DataFrame, array_cols: list[str], out_col: str = "features") -> DataFrame:
    """Concatenate array columns (fixed, documented order) into one ml Vector.

    The arrays are joined natively and converted once. A VectorAssembler over ``array_to_vector``
    columns would have no size metadata and would run a job over the first row (the whole
    upstream plan) just to learn the lengths.
    """
    return df.withColumn(out_col, array_to_vector(F.concat(*[F.col(c) for c in array_cols])))


def genre_indicators(size: int, cols: list[str] = GENRE_COLS):
    """The 0/1 arrays of all eight genre inputs (three of the movie, five of the user), one after the other."""
    return F.concat(*[indicator(f"{c}Index", size) for c in cols])
