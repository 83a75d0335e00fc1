"""Session settings.  Storage is addressed with options only; no code per scheme."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings every job relies on.  Partition sizes are left to AQE: a high initial shuffle
# partition number is coalesced to ``advisoryPartitionSizeInBytes`` at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and descriptions are long; smaller batches bound the memory of a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Recording the call site of every column expression makes long rule chains slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Cost-based join reordering works on catalog tables with collected statistics.
CBO_CONF = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
}


def object_store_conf(endpoint: str | None = None, path_style: bool = True) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    Keys come from the default provider chain (environment, instance profile); none are
    accepted here, so none can end up in code.
    """
    conf = {
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return conf


def hdfs_conf(default_fs: str, datanode_hostname: bool = False) -> dict[str, str]:
    """``spark.hadoop.*`` settings for HDFS (or ``webhdfs://``) as the default file system."""
    return {
        "spark.hadoop.fs.defaultFS": default_fs,
        "spark.hadoop.dfs.client.use.datanode.hostname": str(datanode_hostname).lower(),
    }


def build_session(
    app_name: str = "jobmart",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
