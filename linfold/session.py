"""Session helpers: a local session for tests and benches, and the shared work folder.

Everything this package writes (CSV round trips, saved models, run logs, scratch
databases) goes under the folder the cluster names in ``spark.checkpoint.dir``.
That folder is shared storage on a real cluster; on a local master with no such
setting we create one, which is the only place a machine-local folder is used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("linfold")
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return sc.getConf().get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for files every executor can reach.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and the
    master is local (tests, the bench) is a folder created and registered.
    """
    root = _configured_checkpoint_dir(spark)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="linfold-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    path = root.rstrip("/")
    for p in parts:
        path = f"{path}/{p.strip('/')}"
    return path


def fresh_name(prefix: str) -> str:
    """A unique, SQL-safe name for scratch objects."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
