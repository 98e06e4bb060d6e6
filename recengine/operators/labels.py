"""Labels and label diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.functions.columns import label


def add_label(ratings: DataFrame, threshold: float = S.LABEL_THRESHOLD, rating: str = "rating") -> DataFrame:
    return ratings.withColumn("label", label(rating, threshold))


def positive_ratings(ratings: DataFrame, threshold: float = S.LABEL_THRESHOLD) -> DataFrame:
    """Ratings at or above the threshold; the predicate reaches the parquet scan when rating is stored."""
    return ratings.where(F.col("rating") >= F.lit(threshold))


def sample_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame (partial counts per task, one final add)."""
    return df.agg(F.count(F.lit(1)).alias("sample_count"))


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """Count and share of each rating value, ordered by rating.

    The total is a scalar subquery over the (small) grouped result, so no driver round trip and
    no join: every task reads one number.
    """
    hist = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
    total = hist.agg(F.sum("count")).scalar()
    return hist.select("rating", "count", (F.col("count") / total).alias("percentage")).orderBy("rating")
