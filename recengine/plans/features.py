"""Model inputs over the driver tables: the keyed feature sample with encodings and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.operators import encoders as E
from recengine.operators import vectors as V
from recengine.plans import samples as P
from recengine.sources import fixtures as X

KEYS = ["userId", "movieId", "timestamp", "l_orderkey", "l_linenumber"]
VOCAB = S.GENRE_VOCAB_TESTDATA


def keyed_samples(spark: SparkSession, sf: str, counts: DataFrame | None = None) -> DataFrame:
    return P.user_features(spark, sf, keep_tiebreak=True, counts=counts)


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    """Identity columns as large as the ids of the ratings, so every id has its own slot."""
    counts = P.rating_counts(P.labeled(spark, sf))  # holds every id, so the ratings aren't joined again for the sizes
    return E.with_vocab_indices(E.with_id_buckets(keyed_samples(spark, sf, counts), *E.id_sizes(counts), on_invalid="error"), VOCAB)


def genre_vector_key(index_col: str, vectors: int):
    return F.when(F.col(index_col) >= 0, F.lit(vectors - X.GENRE_VECTORS) + F.col(index_col))


def with_vectors(spark: SparkSession, sf: str, df: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Adds item_vector, user_vector, item_genre_vector, user_genre_vector (zero when missing)."""
    df = df if df is not None else encoded(spark, sf)
    vecs = X.item_vectors(spark, sf)
    d, n = X.vector_dim(spark, sf), X.vector_count(spark, sf)
    small = V.fits_broadcast(vecs, V.rows_for_width(8 * d + 48))
    out = V.lookup(df, X.movie_vectors(spark, sf), "movieId", "item_vector", d)
    out = V.lookup(out, vecs, F.pmod("userId", F.lit(max(1, n))), "user_vector", d, small=small)
    out = V.lookup(out, vecs, genre_vector_key("movieGenre1Index", n), "item_genre_vector", d, small=small)
    out = V.lookup(out, vecs, genre_vector_key("userGenre1Index", n), "user_genre_vector", d, small=small)
    return out, d


def dense_array():
    """numeric(7) + item vector + user vector + the indicators of all eight genre inputs."""
    return F.concat(E.numeric_array(), F.col("item_vector"), F.col("user_vector"), E.genre_indicators(len(VOCAB)))


def dense_size(d: int) -> int:
    return len(E.NUMERIC_FEATURES) + 2 * d + len(E.GENRE_COLS) * len(VOCAB)
