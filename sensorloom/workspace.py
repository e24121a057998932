"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the queries rely on. Sizes (shuffle partitions, memory) belong to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}

# For long-running streams: state off the heap, and only the changes in each checkpoint.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Large payload rows: small Arrow batches by row count as well.
LARGE_ROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession, *groups: dict[str, str]) -> SparkSession:
    """Apply RUNTIME_CONF and any further groups to a session.

    A session in one process also gets no more shuffle partitions than it has cores: every state partition of a
    stream costs files in each micro-batch. On a cluster the number is left as it is set.
    """
    context, partitions = spark.sparkContext, "spark.sql.shuffle.partitions"
    if re.match(r"local(\[|$)", context.master) and int(spark.conf.get(partitions)) > context.defaultParallelism:
        spark.conf.set(partitions, str(context.defaultParallelism))
    for group in (RUNTIME_CONF, *groups):
        for name, value in group.items():
            if spark.conf.get(name, None) != value:
                spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, reachable by all executors.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may go without: it gets a
    temporary folder of its own.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        path = tempfile.mkdtemp(prefix="sensorloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one, in a folder of the session that goes when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/sensorloom-{spark.sparkContext.applicationId}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{path}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, with the lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
