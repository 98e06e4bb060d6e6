"""Session helpers: sensible defaults for local runs, and the checkpoint folder rule.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names (a shared file
system).  Only when it is unset *and* the master is local (tests, laptops) do we create a
private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "recengine", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recengine-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint: cuts lineage and pins non-deterministic ids (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables written as Parquet below spark.checkpoint.dir, which cut the lineage.

    Lost executors cost nothing but the running stage: everything saved is read again from the
    shared folder.  ``drop`` removes a table that no later plan reads; what a returned frame reads
    has to stay until its owner is done with it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._saved: dict[int, tuple[str, DataFrame]] = {}
        self._n = 0

    def save(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._saved[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove saved tables; frames that weren't saved here are left alone."""
        for df in frames:
            path, _ = self._saved.pop(id(df), (None, None))
            if path:
                jvm = self.spark.sparkContext._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def keep_only(self, *frames: DataFrame) -> None:
        """Remove every saved table but these."""
        kept = {id(df) for df in frames}
        self.drop(*(df for i, (_, df) in list(self._saved.items()) if i not in kept))
