"""Session helpers: a configured local session for tests/bench, and the
shared staging folder derived from ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every fareflow job expects; all are plain public Spark confs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's own size check for broadcasting; anything above goes
    # sort-merge (and AQE may still demote to broadcast at run time).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once the checkpointed data is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fareflow", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and ``bench.py`` (not used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("FAREFLOW_DRIVER_MEM", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (DFS/object store)
    folder and is used as is.  Only when it is unset and the master is local
    (tests) a scratch folder is created; elsewhere a missing setting is an
    error, as executors do not share local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="fareflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for materialised
    intermediates (written tables cut lineage and survive executor loss)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fareflow-stage/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting by which a finished write gives up its shuffle files.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def giving_up_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block give up their shuffle files when they are done,
    not when the driver's garbage is collected some time later."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a staged folder this job wrote (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
