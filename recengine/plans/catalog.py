"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.operators import attention as AT
from recengine.operators import encoders as E
from recengine.operators import labels as L
from recengine.operators import metrics as MT
from recengine.operators import movies as M
from recengine.operators import neighbours as N
from recengine.operators import scoring as SC
from recengine.operators import sequences as Q
from recengine.operators import split as B
from recengine.operators import vectors as V
from recengine.plans import features as FT
from recengine.plans import samples as P
from recengine.plans import training as TR
from recengine.schemas import RATINGS as S_RATINGS
from recengine.schemas import SAMPLE_COLUMNS, TESTDATA_ORDER
from recengine.sources import fixtures as X
from recengine.sources import readers as R
from recengine.sources import sinks as K

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- labels (P1 P2 A1 A2) --------------------------------------------------------------------
@query
def rating_histogram(spark, sf):
    return L.rating_histogram(X.ratings(spark, sf))


@query
def sample_count(spark, sf):
    return L.sample_count(P.labeled(spark, sf))


@query
def sample_label(spark, sf):
    return P.labeled(spark, sf).select("userId", "movieId", "rating", "timestamp", "label",
                                       "l_orderkey", "l_linenumber")


@query
def positive_ratings(spark, sf):
    return L.positive_ratings(X.ratings(spark, sf)).select("userId", "movieId", "rating", "timestamp")


# --- movies (P3 P4 A3 J1 J2) -----------------------------------------------------------------
@query
def movie_rating_stats(spark, sf):
    return M.movie_rating_stats(P.labeled(spark, sf))


@query
def movie_features(spark, sf):
    return P.movie_features(spark, sf).select(
        "movieId", "userId", "rating", "timestamp", "label", "title", "releaseYear",
        "movieGenre1", "movieGenre2", "movieGenre3", "movieRatingCount", "movieAvgRating",
        "movieRatingStddev", "l_orderkey", "l_linenumber")


# --- users (W1-W6) ---------------------------------------------------------------------------
@query
def user_features(spark, sf):
    return P.user_features(spark, sf).select(*SAMPLE_COLUMNS)


def _user_keyed(spark, sf, cols):
    keys = ["userId", "movieId", "timestamp", "l_orderkey", "l_linenumber"]
    return P.user_features(spark, sf, keep_tiebreak=True).select(*keys, *cols)


@query
def user_history(spark, sf):
    return _user_keyed(spark, sf, [f"userRatedMovie{i}" for i in range(1, 6)])


@query
def user_rating_count(spark, sf):
    return _user_keyed(spark, sf, ["userRatingCount"])


@query
def user_release_year_stats(spark, sf):
    return _user_keyed(spark, sf, ["userAvgReleaseYear", "userReleaseYearStddev"])


@query
def user_rating_stats(spark, sf):
    return _user_keyed(spark, sf, ["userAvgRating", "userRatingStddev"])


@query
def user_top_genres(spark, sf):
    return _user_keyed(spark, sf, [f"userGenre{i}" for i in range(1, 6)])


# --- movie pieces (P3 P4 P7 P8 J1) -----------------------------------------------------------
@query
def release_year(spark, sf):
    return M.with_release_year(X.movies(spark, sf)).select("movieId", "title", "releaseYear")


@query
def genre_slots(spark, sf):
    return M.with_genre_slots(X.movies(spark, sf)).select("movieId", "genres", "movieGenre1", "movieGenre2",
                                                           "movieGenre3")


@query
def movie_join(spark, sf):
    return M.join_movies(X.ratings(spark, sf), X.movies(spark, sf)).select(
        "userId", "movieId", "timestamp", "l_orderkey", "l_linenumber", "title", "genres")


@query
def fill_missing(spark, sf):
    """Every movie with its rating statistics; movies nobody rated get 0 (na.fill on named columns)."""
    r = X.ratings(spark, sf)
    stats = r.groupBy("movieId").agg(F.count(F.lit(1)).alias("movieRatingCount"),
                                     F.avg("rating").alias("movieAvgRating"),
                                     F.stddev_samp("rating").alias("movieRatingStddev"))
    out = X.movies(spark, sf).select("movieId").join(stats, "movieId", "left")
    return (out.na.fill(0, subset=["movieRatingCount", "movieAvgRating", "movieRatingStddev"])
               .select("movieId", "movieRatingCount", F.round("movieAvgRating", 9).alias("movieAvgRating"),
                       F.round("movieRatingStddev", 9).alias("movieRatingStddev")))


@query
def item_id_cast(spark, sf):
    """Id text -> integer (try_cast: bad text gives null instead of failing the job)."""
    m = X.movies(spark, sf).select("movieId", F.concat(F.lit(""), F.col("movieId").cast("string")).alias("movieIdText"))
    return m.select("movieIdText", F.col("movieIdText").try_cast("int").alias("movieIdNumber"))


# --- sequences (A4 A5 L2) --------------------------------------------------------------------
@query
def item_sequences(spark, sf):
    return Q.item_sequences(X.ratings(spark, sf), order=TESTDATA_ORDER)


@query
def item_sequence_text(spark, sf):
    return Q.sequence_text(Q.item_sequences(X.ratings(spark, sf), order=TESTDATA_ORDER))


# --- sampling and split (B1 B2) --------------------------------------------------------------
SAMPLE_KEY = ["userId", "movieId", "l_orderkey", "l_linenumber"]


@query
def sample_fraction(spark, sf):
    return B.hash_sample(P.labeled(spark, sf), SAMPLE_KEY).select(*SAMPLE_KEY, "timestamp", "label")


@query
def train_test_split(spark, sf):
    return B.train_test_split(P.labeled(spark, sf), SAMPLE_KEY).select(*SAMPLE_KEY, "label", "split")


# --- scans and sinks (S1-S4) -----------------------------------------------------------------
@query
def ratings_scan(spark, sf):
    """Typed headered CSV reader: fixture ratings written as CSV, read back with the schema."""
    path = K.scratch_path(spark, "ratings-csv")
    K.write_csv(X.ratings(spark, sf).select("userId", "movieId", "rating", "timestamp"), path)
    return R.read_ratings(spark, path)


@query
def movies_scan(spark, sf):
    path = K.scratch_path(spark, "movies-csv")
    K.write_csv(X.movies(spark, sf), path)
    return R.read_movies(spark, path)


def _spoiled(spark, sf):
    """Rating lines as a file would have them, some of them spoiled by a rule over the line's keys."""
    r = X.ratings(spark, sf)
    rating = F.when(F.col("l_orderkey") % 97 == 0, F.lit("good")).otherwise(F.col("rating").cast("string"))
    time = F.when(F.col("l_orderkey") % 89 == 0, F.lit("1e")).otherwise(F.col("timestamp").cast("string"))
    more = F.when(F.col("l_orderkey") % 83 == 0, F.lit(",7")).otherwise(F.lit(""))
    return r.select(F.concat(F.concat_ws(",", "userId", "movieId", rating, time), more).alias("value"))


@query
def ratings_quarantine(spark, sf):
    """Bad lines of a rating file, with what is wrong in each."""
    path, quarantine = K.scratch_path(spark, "spoiled-csv"), K.scratch_path(spark, "quarantine")
    _spoiled(spark, sf).write.text(path)
    R.read_quarantined(spark, path, S_RATINGS, quarantine)
    return spark.read.parquet(quarantine).select("line", "reason")


@query
def ratings_quarantine_counts(spark, sf):
    """Lines by what is wrong in them; good lines under a null reason."""
    path = K.scratch_path(spark, "spoiled-csv")
    _spoiled(spark, sf).write.text(path)
    return R.read_quarantined(spark, path, S_RATINGS, K.scratch_path(spark, "quarantine"))[1]


@query
def samples_scan(spark, sf):
    """Feature sample written as headered CSV and read back as the models read it."""
    path = K.scratch_path(spark, "samples-csv")
    K.write_csv(P.user_features(spark, sf), path)
    return R.read_samples(spark, path)


SAMPLE_ROW_KEY = ["userId", "movieId", "timestamp"]


@query
def csv_samples_sink(spark, sf):
    """The job's last step: 10 % hash sample, 80/20 split, one headered CSV folder per part."""
    sampled = B.hash_sample(P.user_features(spark, sf), SAMPLE_ROW_KEY)
    split = B.train_test_split(sampled, SAMPLE_ROW_KEY)
    paths = K.write_train_test(split, K.scratch_path(spark, "train-test"), num_files=4)
    train = R.read_samples(spark, paths["train"]).withColumn("split", F.lit("train"))
    test = R.read_samples(spark, paths["test"]).withColumn("split", F.lit("test"))
    return train.unionByName(test)


# --- previews (L3) ---------------------------------------------------------------------------
@query
def preview(spark, sf):
    """First 20 labelled ratings in a total order (deterministic show())."""
    return P.labeled(spark, sf).orderBy("userId", *TESTDATA_ORDER).limit(20).select(
        "userId", "movieId", "rating", "timestamp", "label", "l_orderkey", "l_linenumber")


# --- encoders (K1 K5-K10) --------------------------------------------------------------------

KEYS = FT.KEYS


@query
def onehot_item_id(spark, sf):
    """One-hot of movie ids (dropLast=False); emits the sparse view (size, index, value)."""
    out, _ = E.onehot_ids(X.movies(spark, sf))
    vector = F.unwrap_udt("movieIdVector")
    return out.select("movieId", vector["size"].alias("size"), F.get(vector["indices"], 0).alias("index"),
                      F.get(vector["values"], 0).alias("value"))


@query
def id_bucket(spark, sf):
    return FT.encoded(spark, sf).select(*KEYS, "movieBucket", "userBucket", "ratedMovieBucket")


@query
def vocab_index(spark, sf):
    return FT.encoded(spark, sf).select(*KEYS, *[f"{c}Index" for c in E.GENRE_COLS])


@query
def indicator(spark, sf):
    n = len(FT.VOCAB)
    both = F.concat(E.indicator("movieGenre1Index", n), E.indicator("userGenre1Index", n))
    return FT.encoded(spark, sf).select(*KEYS, E.active_indices(both).alias("active"))


@query
def crossed_bucket(spark, sf):
    return FT.encoded(spark, sf).select(*KEYS, E.crossed_bucket("movieBucket", "ratedMovieBucket").alias("crossBucket"))


@query
def numeric_features(spark, sf):
    return FT.keyed_samples(spark, sf).select(*KEYS, E.numeric_array().alias("numeric"),
                                              E.history_ids().alias("history"))


@query
def dense_features(spark, sf):
    df, _ = FT.with_vectors(spark, sf)
    return df.select(*KEYS, FT.dense_array().alias("features"))


# --- vector operators (J3 J4 K11-K13 L4 L5) --------------------------------------------------
@query
def embedding_lookup(spark, sf):
    d = X.vector_dim(spark, sf)
    return V.lookup(X.movies(spark, sf).select("movieId"), X.item_vectors(spark, sf), "movieId", "vector", d)


@query
def history_lookup(spark, sf):
    d = X.vector_dim(spark, sf)
    df = FT.keyed_samples(spark, sf).select(*KEYS, *E.HISTORY_COLS)
    out = V.history_lookup(df, X.movie_vectors(spark, sf), E.HISTORY_COLS, d)
    return out.select(*KEYS, "history_vectors", "history_mask")


@query
def history_lookup_large(spark, sf):
    """The same lookup by shuffle joins, as for a vector table too large to broadcast."""
    d = X.vector_dim(spark, sf)
    df = FT.keyed_samples(spark, sf).select(*KEYS, *E.HISTORY_COLS)
    out = V.history_lookup(df, X.movie_vectors(spark, sf), E.HISTORY_COLS, d, max_broadcast_rows=1)
    return out.select(*KEYS, "history_vectors", "history_mask")


@query
def fm_pair_dots(spark, sf):
    df, _ = FT.with_vectors(spark, sf)
    dots = V.pair_dots("item_vector", "user_vector", "item_genre_vector", "user_genre_vector")
    return df.select(*KEYS, *[c.alias(k) for k, c in dots.items()])


@query
def tower_dot_score(spark, sf):
    df, _ = FT.with_vectors(spark, sf)
    return df.select(*KEYS, F.round(V.tower_score("user_vector", "item_vector"), 6).alias("score"))


@query
def history_attention_pool(spark, sf):
    d = X.vector_dim(spark, sf)
    base = FT.keyed_samples(spark, sf).select(*KEYS, *E.HISTORY_COLS)
    hist = V.history_lookup(base, X.movie_vectors(spark, sf), E.HISTORY_COLS, d, item=("movieId", "item_vector"))
    return AT.attention_pool(hist, d).select(*KEYS, "attention_weights", "pooled_history")


SIMILAR_TO = 158   # item probed by the synonym search
NEAREST_TO = 7     # item whose vector probes the exact nearest-neighbour search


@query
def similar_items(spark, sf):
    return V.top_k_similar(X.item_vectors(spark, sf), SIMILAR_TO, k=20)


@query
def nearest_items_exact(spark, sf):
    return V.k_nearest(X.item_vectors(spark, sf), NEAREST_TO, k=5)


# --- scoring and metrics (L6 E1-E5) ----------------------------------------------------------
SCORE_ORDER = ["userId", "timestamp", "l_orderkey", "l_linenumber", "movieId", "l_suppkey", "l_extendedprice"]


@query
def scored_preview(spark, sf):
    return SC.scored_preview(X.scored(spark, sf), SCORE_ORDER, 12)


@query
def eval_log_loss(spark, sf):
    return X.scored(spark, sf).agg(F.round(MT.log_loss(), 9).alias("log_loss"))


@query
def eval_accuracy(spark, sf):
    return X.scored(spark, sf).agg(F.round(MT.accuracy(), 9).alias("accuracy"))


@query
def eval_roc_auc(spark, sf):
    return MT.areas(X.scored(spark, sf)).select(F.round("roc_auc", 9).alias("roc_auc"))


@query
def eval_pr_auc(spark, sf):
    return MT.areas(X.scored(spark, sf)).select(F.round("pr_auc", 9).alias("pr_auc"))


@query
def eval_summary(spark, sf):
    return MT.summary(X.scored(spark, sf))


# --- learned vectors, LSH, sinks, forward pass, models (K2-K4 K14 S5 S6 M1-M7) -----------------
# No SQL twin: these fit models; the driver checks rows, pytest checks properties.


@query
def item2vec(spark, sf):
    return TR.item2vec_vectors(spark, sf)


@query
def lsh_buckets(spark, sf):
    """Hash values of every vector of the embeddings table."""
    model, df = V.lsh_model(X.item_vectors(spark, sf))
    return V.lsh_buckets(model, df)


@query
def lsh_nearest(spark, sf):
    """Approximate neighbours of item 7's vector; pytest measures the recall of this setting against the exact ones."""
    vectors = X.item_vectors(spark, sf)
    model, df = V.lsh_model(vectors, bucket_length=2.0, tables=8)
    probe = vectors.where(F.col("id") == NEAREST_TO).select("vector").first()
    return V.lsh_nearest(model, df, list(probe[0]) if probe else [0.0] * X.vector_dim(spark, sf), 5)


@query
def lsh_neighbours(spark, sf):
    """Five approximate neighbours of every item (K4, batch form); pytest measures the recall of these parameters."""
    return N.lsh_neighbours(X.item_vectors(spark, sf))


@query
def item_vector_sink(spark, sf):
    """Vectors written as `id:v1 v2 ...` text by the executors, read back and parsed."""
    path = K.scratch_path(spark, "item-vectors")
    K.write_item_vectors(X.item_vectors(spark, sf), path, id_col="id")
    parts = F.split("value", ":")
    return spark.read.text(path).select(
        parts[0].cast("bigint").alias("id"),
        F.transform(F.split(parts[1], " "), lambda x: x.cast("float").cast("double")).alias("vector"))


@query
def dense_forward(spark, sf):
    """A dense stack with weights from a rule, in Arrow batches; the SQL twin does the same sums."""
    df, d = FT.with_vectors(spark, sf)
    layers = SC.small_rule_layers([FT.dense_size(d), 128, 128, 1])
    out = SC.dense_forward(df.select(*KEYS, FT.dense_array().alias("features")), "features", KEYS, layers)
    return out.withColumn("score", F.round("score", 6))


@query
def model_sink(spark, sf):
    """Fit a family, save it, load it back and score every held-out row with the loaded model."""
    from recengine.operators.recommenders import Recommender

    train, test = TR.train_and_test(spark, sf)
    path = K.scratch_path(spark, "model")
    Recommender("two_tower", FT.VOCAB).fit(train).save(path)
    return Recommender.load(spark, path).score(test).select(*KEYS, F.round("p", 9).alias("p"))


@query
def batch_score(spark, sf):
    return TR.batch_score(spark, sf)


@query
def train_embedding_mlp(spark, sf):
    return TR.train_family(spark, sf, "embedding_mlp")


@query
def train_ncf_concat(spark, sf):
    return TR.train_family(spark, sf, "ncf_concat")


@query
def train_two_tower(spark, sf):
    return TR.train_family(spark, sf, "two_tower")


@query
def train_deep_fm(spark, sf):
    return TR.train_family(spark, sf, "deep_fm")


@query
def train_wide_deep(spark, sf):
    return TR.train_family(spark, sf, "wide_deep")


@query
def train_interest_net(spark, sf):
    return TR.train_family(spark, sf, "interest_net")


@query
def history_attention_net(spark, sf):
    """K13 net form: an activation unit with PReLU, Arrow-batched; weights from a rule, as in the SQL twin."""
    d = X.vector_dim(spark, sf)
    base = FT.keyed_samples(spark, sf).select(*KEYS, *E.HISTORY_COLS)
    hist = V.history_lookup(base, X.movie_vectors(spark, sf), E.HISTORY_COLS, d, item=("movieId", "item_vector"))
    out = AT.attention_net(hist, d, KEYS, SC.small_rule_layers([4 * d, 32, 1]))
    return out.select(*KEYS, *[F.transform(c, lambda v: F.round(v, 6)).alias(c) for c in ("attention_weights", "pooled_history")])


@query
def similar_items_model(spark, sf):
    """L4 on the learned vectors: findSynonyms of item 158 (empty when absent from the vocabulary)."""
    return TR.item2vec_model(spark, sf).synonyms(str(SIMILAR_TO), 20)
