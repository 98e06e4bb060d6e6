"""A corpus pipeline of five stages, each one operator of recengine.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and
read again as the next one's docs.  All but the last return the columns of documents.

toxicity          rows predicted toxic go
ngram_join        of each group of near copies the row of the smallest id stays
decontamination   rows that hold a benchmark item go
secrets           secrets are masked in the text, and n_chars follows
mixing            the words that the mix takes of each row
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm import mixing, secrets
from recengine.llm import toxicity as tox
from recengine.llm.common import Scratch, crc_text, fresh_name
from recengine.llm.decontaminate import find_leaks, without_leaks
from recengine.llm.ngram_join import one_of_each


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = tox.fit(docs, labels, learn=crc_text(F.col("doc_id")) % 5 != 0)
    score, toxic = fresh_name(docs, "score"), fresh_name(docs, "toxic")
    kept = tox.score(docs, model, score=score, predicted=toxic, evidence=None).where(F.col(toxic) == 0)
    return kept.select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_leaks(docs, find_leaks(docs, benchmark, least_words=1)).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans, clean = fresh_name(docs, "found"), fresh_name(docs, "clean")
    found = secrets.scan(docs, found=spans)
    out = found.withColumn(clean, secrets.masked(F.col("text"), F.col(spans))).withColumn(
        "n_chars", F.when(F.size(spans) > 0, F.char_length(clean).cast("long")).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(clean)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("mixing", mix_sources),
]

#: The classifier and the seeds can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        after = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return after
        after = scratch.save(after)
        scratch.drop(docs)
        docs = after
    return docs
