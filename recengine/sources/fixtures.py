"""Ratings, movies and vectors derived from the driver's parquet tables (see FIXTURES.md).

Every query reads these whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.functions.arrays import to_double_array

# Vectors kept for genres: the last ones of the embeddings table (fixture rule).
GENRE_VECTORS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per line item of a known order; carries the tie-breaker columns."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).alias("rating"),
        (F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86400).alias("timestamp"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies with and without a year in the title, one to three genres; every row of part."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    key = F.col("p_partkey")
    name_word = lambda i: F.get(F.split(F.col("p_name"), " "), i)
    return p.select(
        key.alias("movieId"),
        F.when(key % 97 == 0, F.col("p_name"))
         .otherwise(F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1949) + F.col("p_size")).cast("string"),
                             F.lit(")"))).alias("title"),
        F.concat_ws("|", F.col("p_type"),
                    F.when(key % 3 >= 1, name_word(0)),
                    F.when(key % 3 == 2, name_word(1))).alias("genres"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vector array<double>) from the embeddings table; id = vec_id."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), to_double_array("embedding").alias("vector"))


def vector_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "embeddings").count()


def movie_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vector) for every movie: movie m has the vector of id m modulo the number of vectors."""
    v = item_vectors(spark, sf_dir).withColumnRenamed("id", "vec_id")
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return keys.join(v, F.pmod("id", F.lit(max(1, vector_count(spark, sf_dir)))) == F.col("vec_id")).select("id", "vector")


def vector_dim(spark: SparkSession, sf_dir: str) -> int:
    """Dimension of the fixture vectors (one row read from the table)."""
    row = table(spark, sf_dir, "embeddings").select(F.size("embedding").alias("d")).limit(1).collect()
    return int(row[0]["d"]) if row else 0


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-form probability per rating plus label, so every engine sees identical scores."""
    r = ratings(spark, sf_dir)
    z = ((F.col("movieId") % 11) - 5 + (F.col("userId") % 7) - 3 + F.col("rating")) / F.lit(4.0)
    return r.select(
        "userId", "movieId", "timestamp", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
        F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6).alias("p"),
        F.when(F.col("rating") >= 3.5, 1).otherwise(0).alias("label"),
    )
