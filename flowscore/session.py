"""Session construction and the shared folder used to cut lineage.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(an HDFS / object-store path visible to every executor).  Only when it is
unset -- local runs and tests -- do we create one of our own under /tmp.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all of them can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Coalesce post-shuffle partitions (and rebalanced output files) to the
    # advisory size instead of keeping one per core: fewer tiny tasks and
    # files on a large shared cluster.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    # Reliable checkpoints (bucket counts, batch sizes, tree node ids) are
    # removed from the shared folder once their DataFrame is out of scope.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Initial shuffle partitions per core (see ``initial_shuffle_partitions``).
SHUFFLE_PARTITIONS_PER_CORE = 4


def get_session(master: str | None = None, app_name: str = "flowscore",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not shuffle_partitions and not spark.sparkContext.getConf().contains(
            "spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions",
                       str(initial_shuffle_partitions(spark.sparkContext.defaultParallelism)))
    return spark


def initial_shuffle_partitions(cores: int, per_core: int = SHUFFLE_PARTITIONS_PER_CORE,
                               floor: int = 200) -> int:
    """Shuffle partitions when neither the caller nor the cluster set them.

    AQE can only merge shuffle partitions, never split them (except skewed
    join / rebalance partitions), so the initial count must be large enough
    for the biggest shuffle: a few waves per core.  Small shuffles (most of
    ours follow a partial aggregation) are coalesced back to
    ``advisoryPartitionSizeInBytes`` at run time."""
    return max(floor, per_core * int(cores))


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jdir.get() if jdir.isDefined() else None


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; sets a local one only
    when it is unset on a local master (tests).  On a cluster an unset folder
    is an error: executors would each write to their own disk.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="flowscore-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    return shared_dir(spark, "flowscore", kind, uuid.uuid4().hex)


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_local_parent(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file://", ""), exist_ok=True)
