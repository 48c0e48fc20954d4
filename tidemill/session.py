"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours uses; a cluster's own settings win where given.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemill", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, ``spark.checkpoint.dir``.

    On a cluster it must be set to a folder that all executors share (HDFS, S3, ...): without it this
    raises. Only a local master, whose executors share the machine, gets a scratch folder."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; master {master} needs a folder that all executors share")
        d = os.path.join("/tmp", "tidemill-checkpoints", spark.sparkContext.applicationId)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments refuse runtime core confs
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def tune_for_scale(spark: SparkSession) -> None:
    """Turn on adaptive execution, partition coalescing and skew-join splitting where the
    session leaves them unset (a cluster's explicit settings are kept)."""
    for k, v in (("spark.sql.adaptive.enabled", "true"),
                 ("spark.sql.adaptive.coalescePartitions.enabled", "true"),
                 ("spark.sql.adaptive.skewJoin.enabled", "true")):
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet below the shared checkpoint folder: the table read back, and its path for ``discard``."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``store`` wrote, once nothing reads it any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
