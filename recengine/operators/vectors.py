"""Vector operators.

Vector tables are ``(id, vector array<double>)``. Lookups are joins (broadcast only after a
bounded row count); similarity search is an expression plus ``orderBy().limit(k)``, which Spark
plans as a per-task top-k merged once (TakeOrderedAndProject), never a global sort.
"""

from __future__ import annotations

from pyspark.ml.feature import BucketedRandomProjectionLSH, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.functions.arrays import cosine, dot, l2_distance, zeros
from recengine.functions.columns import sigmoid
from recengine.operators.joins import DEFAULT_BROADCAST_ROWS, fits_broadcast, rows_for_width
from recengine.session import reliable_checkpoint

# Sequences one training task takes about.
SEQUENCES_PER_TASK = 2_000
# Tasks that null keys of a shuffle join are spread over.
NULL_SALTS = 1024
# Neighbouring rows that ask for their vectors together; a row looks through the block's ids.
BLOCK_ROWS = 256


def lookup(df: DataFrame, vectors: DataFrame, key, out_col: str, dim: int,
           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, small: bool | None = None) -> DataFrame:
    """Left join ``vectors`` on ``key`` (a column of ``df`` or an expression); missing -> zero vector.

    In the shuffle join a null key, which matches nothing, is spread over many tasks by a salt.
    """
    k = F.col(key) if isinstance(key, str) else key
    v = vectors.select(F.col("id").alias("_lk_id"), F.col("vector").alias("_lk_vec"))
    if small is None:
        small = fits_broadcast(vectors, rows_for_width(8 * dim + 48, max_broadcast_rows))
    if small:
        out = df.join(F.broadcast(v), k == F.col("_lk_id"), "left")
    else:
        salt = F.when(k.isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SALTS - 1)) + 1).otherwise(F.lit(0))
        keyed = df.withColumns({"_lk_key": k, "_lk_salt": salt})
        out = keyed.join(v.withColumn("_lk_zero", F.lit(0).cast("bigint")),
                         (F.col("_lk_key") == F.col("_lk_id")) & (F.col("_lk_salt") == F.col("_lk_zero")), "left")
    return (out.withColumn(out_col, F.coalesce(F.col("_lk_vec"), zeros(dim)))
               .drop("_lk_id", "_lk_vec", "_lk_key", "_lk_salt", "_lk_zero"))


def travelling(vectors: DataFrame) -> DataFrame:
    """The vectors as they are shuffled: as floats if every number is one (half the bytes, nothing lost), else as they are."""
    exact = F.coalesce(F.forall("vector", lambda x: F.coalesce(x.cast("float").cast("double") == x, F.lit(True))), F.lit(True))
    floats = vectors.agg(F.bool_and(exact)).first()[0]
    return vectors.withColumn("vector", F.col("vector").cast("array<float>")) if floats else vectors


def asked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(_block, _id): the different ids of each block's rows."""
    ids = F.explode(F.array(*[F.col(c).cast("bigint") for c in keys]))
    return rows.select("_block", ids.alias("_id")).where("_id is not null").distinct()


def history_lookup(df: DataFrame, vectors: DataFrame, slot_cols: list[str], dim: int,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, item: tuple[str, str] | None = None) -> DataFrame:
    """Adds ``history_vectors`` (one vector per slot, zero when missing) and ``history_mask``.

    ``item`` = (key, column) looks up one more id in the same pass, as :func:`lookup` would: a candidate's vector.

    A small vector table is broadcast, one join per slot. Else the rows are numbered and pinned, and ``BLOCK_ROWS``
    neighbouring rows form a block, which asks for each of its ids once: histories of neighbours are mostly the same.
    The narrow records (block, id) meet the vectors (AQE splits hot items), a block's vectors are gathered in one array, and
    its rows take theirs from it; so a vector is shuffled once for a block, not once for each row and slot. Either way
    each row keeps its own slots, whatever its other columns. Ids of ``vectors`` are unique.
    """
    mask = F.array(*[F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in slot_cols])
    small = fits_broadcast(vectors, rows_for_width(8 * dim + 48, max_broadcast_rows))
    if small:
        out = df
        for i, c in enumerate(slot_cols):
            out = lookup(out, vectors, c, f"_h{i}", dim, small=True)
        hv = F.array(*[F.col(f"_h{i}") for i in range(len(slot_cols))])
        out = out.withColumn("history_vectors", hv).withColumn("history_mask", mask).drop(*[f"_h{i}" for i in range(len(slot_cols))])
        return lookup(out, vectors, item[0], item[1], dim, small=True) if item else out
    keys = [*slot_cols, *([item[0]] if item else [])]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = reliable_checkpoint(rows.withColumn("_block", F.floor(F.col("_row") / BLOCK_ROWS)).drop("_row"))
    met = asked(rows, keys).join(travelling(vectors.select(F.col("id").cast("bigint").alias("_id"), "vector")), "_id")
    # Dealt out by block first: gathering before the shuffle would sort the vectors and combine nothing.
    met = met.repartition("_block").groupBy("_block").agg(F.collect_list(F.struct("_id", "vector")).alias("_met"))
    met = met.select("_block", F.transform("_met", lambda x: x["_id"]).alias("_ids"), F.transform("_met", lambda x: x["vector"]).alias("_vectors"))

    def found(c: str) -> "F.Column":
        at = F.array_position("_ids", F.col(c).cast("bigint")).cast("int") - 1
        return F.coalesce(F.get("_vectors", at).cast("array<double>"), zeros(dim))

    out = rows.join(met, "_block", "left").withColumn("history_vectors", F.array(*[found(c) for c in slot_cols])).withColumn("history_mask", mask)
    out = out.withColumn(item[1], found(item[0])) if item else out
    return out.drop("_block", "_ids", "_vectors")


def pair_dots(item, user, item_genre, user_genre, places: int = 6) -> dict[str, "F.Column"]:
    """The four pairwise interactions of the factorisation part."""
    r = lambda x: F.round(x, places)
    return {"dot_item_user": r(dot(item, user)), "dot_genre_genre": r(dot(item_genre, user_genre)),
            "dot_itemgenre_user": r(dot(item_genre, user)), "dot_item_usergenre": r(dot(item, user_genre))}


def tower_score(user, item, w: float = 1.0, b: float = 0.0):
    """sigmoid(w * <user, item> + b)."""
    return sigmoid(F.lit(w) * dot(user, item) + F.lit(b))


def probe_vector(vectors: DataFrame, item_id):
    """The vector of one item as a literal array column (one bounded row read), or None."""
    row = vectors.where(F.col("id") == F.lit(item_id)).select("vector").limit(1).collect()
    if not row or row[0][0] is None:
        return None
    return F.array(*[F.lit(float(x)) for x in row[0][0]])


def top_k_similar(vectors: DataFrame, item_id, k: int = 20, places: int = 6) -> DataFrame:
    """k most cosine-similar items to ``item_id``, itself excluded (L4). The probe vector is read
    once (d numbers) and inlined, so there is no join; an absent id gives an empty result. Items are
    ranked by the full value; null and zero vectors have no similarity and are left out."""
    probe = probe_vector(vectors, item_id)
    if probe is None:
        return vectors.where(F.lit(False)).select("id", F.lit(0.0).alias("similarity"))
    best = (vectors.where((F.col("id") != F.lit(item_id)) & F.col("vector").isNotNull())
                   .select("id", cosine("vector", probe).alias("similarity")).where(F.col("similarity").isNotNull())
                   .orderBy(F.col("similarity").desc(), F.col("id")).limit(k))
    return best.select("id", F.round("similarity", places).alias("similarity"))


def k_nearest(vectors: DataFrame, probe, k: int = S.LSH_NEIGHBOURS, places: int = 6) -> DataFrame:
    """Exact k nearest by Euclidean distance to a probe (list of floats or an item id).

    Ranked by the full value, rounded after; null vectors and those of another length are left out."""
    p = probe if isinstance(probe, (list, tuple)) else probe_vector(vectors, probe)
    if p is None:
        return vectors.where(F.lit(False)).select("id", F.lit(0.0).alias("distance"))
    if isinstance(p, (list, tuple)):
        p = F.array(*[F.lit(float(x)) for x in p])
    near = (vectors.where(F.size("vector") == F.size(p)).select("id", l2_distance("vector", p).alias("distance"))
                   .where(F.col("distance").isNotNull()).orderBy("distance", "id").limit(k))
    return near.select("id", F.round("distance", places).alias("distance"))


# --- learned vectors and LSH -----------------------------------------------------------------
def train_item2vec(sequences: DataFrame, dim: int = S.EMBEDDING_SIZE, window: int = S.W2V_WINDOW,
                   iterations: int = S.W2V_ITERATIONS, min_count: int = 5, seed: int = 42,
                   partitions: int | None = None, col: str = "movieIds"):
    """Skip-gram item vectors (K2), trained in ``partitions`` tasks: by default one for every
    ``SEQUENCES_PER_TASK`` sequences, so training spreads as the data grow."""
    partitions = partitions or max(1, -(-sequences.count() // SEQUENCES_PER_TASK))
    w2v = Word2Vec(vectorSize=dim, windowSize=window, maxIter=iterations, minCount=min_count, seed=seed,
                   numPartitions=partitions, inputCol=col, outputCol="_w2v")
    return w2v.fit(sequences.select(col))


def model_vectors(model) -> DataFrame:
    """(word, vector array<double>) — a distributed frame, not a driver map."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def synonyms(model, word: str, k: int = 20) -> DataFrame:
    """findSynonyms with an absent word giving an empty frame instead of an exception."""
    spark = model.getVectors().sparkSession
    if model.getVectors().where(F.col("word") == word).limit(1).count() == 0:
        return spark.createDataFrame([], "word string, similarity double")
    return model.findSynonyms(word, k)


def lsh_model(vectors: DataFrame, bucket_length: float = S.LSH_BUCKET_LENGTH, tables: int = S.LSH_TABLES,
              seed: int = 42):
    """Bucketed random projection LSH fitted on (id, vector) (K3)."""
    df = vectors.select("id", array_to_vector("vector").alias("emb"))
    brp = BucketedRandomProjectionLSH(inputCol="emb", outputCol="bucketId", bucketLength=bucket_length,
                                      numHashTables=tables, seed=seed)
    return brp.fit(df), df


def lsh_buckets(model, df: DataFrame) -> DataFrame:
    """(id, buckets array<double>) — one hash value per table."""
    out = model.transform(df)
    return out.select("id", F.transform("bucketId", lambda v: vector_to_array(v)[0]).alias("buckets"))


def lsh_nearest(model, df: DataFrame, probe: list[float], k: int = S.LSH_NEIGHBOURS) -> DataFrame:
    """Approximate k nearest neighbours of a probe vector (K4)."""
    from pyspark.ml.linalg import Vectors

    out = model.approxNearestNeighbors(df, Vectors.dense(probe), k)
    return out.select("id", F.round("distCol", 6).alias("distance"))
