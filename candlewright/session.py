"""Session helpers: recommended settings and reliable checkpointing."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

MARKET_TIME_ZONE = "Asia/Ho_Chi_Minh"

# Settings a production session should carry; all are ordinary Spark options.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": MARKET_TIME_ZONE,
}


def build_session(app_name: str = "candlewright", **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster; only a single-machine session may go without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="candlewright-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables of this session lie."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def pinned(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so that every later branch sees the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
