"""recengine — Spark-native rating features, item vectors, encoders, models and metrics.

Layout:
    sources/    typed readers and distributed sinks, driver-table fixtures
    functions/  Column expressions (labels, years, two-decimal text, hashes, vector math)
    operators/  DataFrame -> DataFrame building blocks (labels, movies, users, sequences, ...)
    plans/      end-to-end jobs and the named query catalogue
"""

from recengine.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
