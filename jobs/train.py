"""Model job: train/test sample folders (as written by build_samples) -> one of the six model families ->
held-out scores, a preview, log loss / accuracy / ROC / PR (parquet) + saved model.

    spark-submit jobs/train.py SAMPLES OUT [--model FAMILY] [--format csv|parquet] [--vocab A,B,...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None, spark=None):
    from recengine.operators.recommenders import FAMILIES

    ap = argparse.ArgumentParser()
    ap.add_argument("samples")
    ap.add_argument("out")
    ap.add_argument("--model", default="embedding_mlp", choices=FAMILIES)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"], help="format of the sample folders")
    ap.add_argument("--vocab", default=None, help="comma-separated genre vocabulary (index order)")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from recengine import schemas as S
    from recengine.operators import models as MD
    from recengine.operators import scoring as SC
    from recengine.plans.training import new_model
    from recengine.session import ensure_checkpoint_dir
    from recengine.sources import readers

    own = spark is None
    spark = spark or SparkSession.builder.appName("train").getOrCreate()
    ensure_checkpoint_dir(spark)
    vocab = a.vocab.split(",") if a.vocab else S.GENRE_VOCAB_MOVIELENS
    train, test = (readers.read_samples(spark, f"{a.samples}/split={part}", fmt=a.format) for part in ("train", "test"))
    model = new_model(a.model, vocab).fit(train)
    model.save(f"{a.out}/model")
    scores = f"{a.out}/scores"
    model.score(test).write.mode("overwrite").parquet(scores)
    scored = spark.read.parquet(scores)
    SC.scored_preview(scored, ["userId", "timestamp", "movieId", "rating"], 12).write.mode("overwrite").parquet(f"{a.out}/preview")
    MD.evaluate(scored, a.model).write.mode("overwrite").parquet(f"{a.out}/summary")
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
