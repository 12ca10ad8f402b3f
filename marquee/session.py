"""Session construction and shared scratch locations.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``; a local session without one (tests) gets a private
folder under the system temp dir. A cluster session without one is an error:
its driver and executors share no machine-local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (a
# sort-merge join becomes a broadcast only after the shuffle has measured the
# small side), splits skewed join partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "marquee", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="marquee-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        return root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/marquee/{name}-{uuid.uuid4().hex[:12]}"


def together(*jobs):
    """Results of independent steps, in their order, run at the same time: the tasks of one fill the cores that the
    few tasks of another leave idle. All have ended when an error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        futures = [pool.submit(job) for job in jobs]
    return [f.result() for f in futures]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
