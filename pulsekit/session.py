"""Session construction and the shared scratch folder.

On a cluster the session comes configured; ``build_session`` is for tests,
the bench and local runs.  Scratch output (CSV hand-overs, landing folders,
stream checkpoints) always goes below ``spark.checkpoint.dir`` - the shared
folder the cluster names - and a local folder is only chosen when that
setting is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution (runtime partition
# coalescing, skew-join splitting), NTZ-friendly UTC zone, no UI server.
# Broadcasts are decided only on measured sizes: the static planner's
# estimate ignores row growth (an explode of activities into minutes is
# ~50x its input), so static broadcasting is off and AQE broadcasts a join
# side only when its materialised shuffle output is under the threshold.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # small shuffles feeding CPU-heavy work (document parsing, explosions)
    # keep their parallelism instead of being merged into one or two tasks;
    # large shuffles are governed by the advisory size above
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "pulsekit",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A private local folder is chosen only when the setting is unset *and* the
    master runs in this process; on a cluster an unset folder is an error,
    since executors would otherwise write to their own disks and a later read
    would silently miss rows.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_single_process(sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver "
                               f"and all executors of {sc.master} share")
        configured = tempfile.mkdtemp(prefix="pulsekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def is_single_process(master: str) -> bool:
    """True for ``local``, ``local[n]``, ``local[*]``; not for ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder (never reused).

    It is removed when the driver's JVM closes its file systems."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
