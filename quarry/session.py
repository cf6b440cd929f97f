"""Session helpers: building a session and finding the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with AQE on and the UI off. On a cluster pass ``master=None``
    and let spark-submit decide; shuffle partitions then come from the cluster
    configuration unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names durable shared storage and is used as is.
    Only when it is unset (tests, a laptop) do we create a scratch folder and
    register it, so that ``DataFrame.checkpoint()`` works."""
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        # the setting is fixed once the context runs; register the folder
        # with the context only
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    return f"{checkpoint_dir(spark)}/quarry/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
