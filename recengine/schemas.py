"""Typed schemas and the fixed values the features depend on."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),  # epoch seconds
])

MOVIES = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),   # "Name (YYYY)"
    T.StructField("genres", T.StringType()),  # "A|B|C"
])

# ---------------------------------------------------------------------------------------------
# Fixed values (must stay equal for equal results)
# ---------------------------------------------------------------------------------------------
LABEL_THRESHOLD = 3.5          # label = 1 when rating >= 3.5
DEFAULT_RELEASE_YEAR = 1990    # release year when the title carries none
NUMBER_PRECISION = 2           # decimals of the formatted statistics
HISTORY_FRAME = 100            # ratings looked back, current row excluded
HISTORY_SLOTS = 5              # userRatedMovie1..5 and userGenre1..5
MOVIE_GENRE_SLOTS = 3          # movieGenre1..3
MIN_PRIOR_RATINGS = 1          # keep rows with userRatingCount > 1
MOVIE_ID_BUCKETS = 1001        # identity column sizes of the models (defaults; queries take them from the data)
USER_ID_BUCKETS = 30001
CROSS_BUCKETS = 10000          # movieId x userRatedMovie1 hashed cross
EMBEDDING_SIZE = 10            # item2vec vector size
W2V_WINDOW = 5
W2V_ITERATIONS = 10
LSH_BUCKET_LENGTH = 0.1
LSH_TABLES = 3
LSH_NEIGHBOURS = 5
SAMPLE_FRACTION = 0.1
TRAIN_SHARE = 0.8
# The movie genre vocabulary of the models, in index order.
GENRE_VOCAB_MOVIELENS = ["Film-Noir", "Action", "Adventure", "Horror", "Romance", "War", "Comedy",
                         "Western", "Documentary", "Sci-Fi", "Drama", "Thriller", "Crime", "Fantasy",
                         "Animation", "IMAX", "Mystery", "Children", "Musical"]
# Probe vector of the LSH nearest-neighbour demo (10-d item2vec space).
LSH_PROBE_VECTOR = [0.795, 0.583, 1.120, 0.850, 0.174, -0.839, -0.0633, 0.249, 0.673, -0.237]
# ---------------------------------------------------------------------------------------------

# Vocabulary for the driver test tables (part types), in index order.
GENRE_VOCAB_TESTDATA = ["ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE"]

# Full order key of the driver-table ratings: timestamp first, then tie-breakers so that the
# order inside a user is total (day-granular timestamps tie constantly).
TESTDATA_ORDER = ["timestamp", "l_orderkey", "l_linenumber", "movieId", "l_suppkey", "l_extendedprice"]

# Columns of the feature sample, in the reference's order (timestamps typed, ids typed).
SAMPLE_COLUMNS = [
    "movieId", "userId", "rating", "timestamp", "label", "title", "releaseYear",
    "movieGenre1", "movieGenre2", "movieGenre3", "movieRatingCount", "movieAvgRating", "movieRatingStddev",
    "userRatedMovie1", "userRatedMovie2", "userRatedMovie3", "userRatedMovie4", "userRatedMovie5",
    "userRatingCount", "userAvgReleaseYear", "userReleaseYearStddev", "userAvgRating", "userRatingStddev",
    "userGenre1", "userGenre2", "userGenre3", "userGenre4", "userGenre5",
]

SAMPLES = T.StructType([
    T.StructField("movieId", T.LongType()), T.StructField("userId", T.LongType()),
    T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType()),
    T.StructField("label", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("releaseYear", T.IntegerType()),
    *[T.StructField(f"movieGenre{i}", T.StringType()) for i in (1, 2, 3)],
    T.StructField("movieRatingCount", T.LongType()),
    T.StructField("movieAvgRating", T.StringType()), T.StructField("movieRatingStddev", T.StringType()),
    *[T.StructField(f"userRatedMovie{i}", T.LongType()) for i in range(1, 6)],
    T.StructField("userRatingCount", T.LongType()), T.StructField("userAvgReleaseYear", T.IntegerType()),
    T.StructField("userReleaseYearStddev", T.StringType()), T.StructField("userAvgRating", T.StringType()),
    T.StructField("userRatingStddev", T.StringType()),
    *[T.StructField(f"userGenre{i}", T.StringType()) for i in range(1, 6)],
])
