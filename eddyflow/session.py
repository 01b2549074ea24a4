"""Session settings and the shared working folder.

Everything the library writes for itself (staged stream input, intermediate
tables, checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``, read from the session.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from .storage import drop_at_exit

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings the jobs are designed for.  AQE re-plans joins and aggregates from
# runtime sizes (broadcast conversion, partition coalescing, skew splitting).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_dropped_at_exit: set[str] = set()


def build_session(master: str | None = None, app_name: str = "eddyflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the recommended settings; ``master`` is left to the
    launcher when None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    It must be set on a cluster, where a folder of this machine would be
    invisible to the executors; a local session without it gets a temporary
    folder of its own, registered as its checkpoint folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="eddyflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one run of ``name``.
    The application's folders are removed when its driver ends."""
    own = f"{checkpoint_root(spark)}/eddyflow/{spark.sparkContext.applicationId}"
    if own not in _dropped_at_exit:
        _dropped_at_exit.add(own)
        drop_at_exit(spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)
