"""Session helpers: the settings every job in this package assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the package relies on. UTC keeps every date/hour derivation stable across
# clusters; AQE re-plans joins from runtime sizes and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "metrolens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, submit with the same BASE_CONF keys instead."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf["spark.ui.showConsoleProgress"] = "false"
    # Local runs use small inputs: let AQE keep post-shuffle partitions down to 32 KB
    # (default 1 MB) so CPU-heavy stages after small shuffles still use every core.
    # Cluster runs keep the defaults (partitions are sized by data there).
    conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "32k"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None if unset)."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests, a laptop) gets a fresh temporary
    folder; on a cluster a machine-local folder would be wrong (executors would write
    to their own disks), so a missing setting is an error there."""
    value = checkpoint_dir(spark)
    if value is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) "
                               "for checkpoints and staged writes")
        value = tempfile.mkdtemp(prefix="metrolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", value)
    spark.sparkContext.setCheckpointDir(value)
    return value


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for staged (lineage-cutting) writes."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stage-{name}-{uuid.uuid4().hex[:12]}"
