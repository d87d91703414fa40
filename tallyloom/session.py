"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    return builder.config(map=base | conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir; one of our own only where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    own = os.environ.get("TALLYLOOM_CHECKPOINT_DIR") or os.path.join(tempfile.gettempdir(), "tallyloom-checkpoint")
    return f"file://{own}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of ``df`` in the shared folder; it survives lost executors."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
