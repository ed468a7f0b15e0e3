"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry. AQE re-plans joins and aggregations at runtime,
# coalesces small shuffle partitions and splits skewed join partitions, which is what keeps
# a hot product, customer or grid cell from landing in a single task.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Remove reliable checkpoint files once their DataFrames are unreachable (the greedy
    # cover's incremental state writes one per step).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "pinwheel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the base settings.

    ``master`` and ``shuffle_partitions`` are only meant for local runs and tests; on a
    cluster leave them unset and let the cluster configuration decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("PINWHEEL_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; only operators that write to it ask for it.

    It is the one that the session names in ``spark.checkpoint.dir``. For a local master
    without that setting (tests) a scratch folder is made, and removed when Python ends. On a
    cluster a machine-local folder would not survive the loss of an executor, so none is invented.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running operators that checkpoint")
        configured = tempfile.mkdtemp(prefix="pinwheel-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
