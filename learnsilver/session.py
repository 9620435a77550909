"""Session helpers: a configured session for local work, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

TUNING = {
    # Wide rows make long generated methods, and the JVM does not compile methods
    # beyond this size; Spark then splits the work into smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Noting the place of every column expression costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    **TUNING,
}

def local_session(cpus: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("learnsilver")
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for scratch tables, which every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, it
    is a folder of Spark's warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
