"""Spark session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "indexloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; extra settings by keyword or dict."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. A session without it is an
    error on a cluster, whose executors would each write to a disk of their own; a
    local session gets one, remembered in its settings.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="indexloom-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/indexloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage
    that outlives lost executors and fixes the rows of a non-repeatable step."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Jobs that run at once where several tables are written: small ones fill the gaps that large ones leave.
AT_ONCE = 4


def materialize_all(frames: dict[str, DataFrame], label: str) -> dict[str, DataFrame]:
    """``materialize`` for several tables, a few at a time."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(frames, pool.map(lambda name: materialize(frames[name], f"{label}-{name}"), frames)))
