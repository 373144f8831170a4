"""Session construction and shared-folder helpers.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
only set our own when it is unset (local tests).  All scratch output
(streaming checkpoints, landing files, materialised intermediates) is placed
under that folder, never under a machine-local temp dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings that matter for correctness in every environment.
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Runtime SQL settings for the 100 TB / 1000-executor target.  Applied by
# ``apply_cluster_defaults`` only where the cluster has not set them.
CLUSTER_CONF = {
    # AQE: start every shuffle with 100k partitions (a 30 TB raw-row shuffle
    # is then ~300 MB per partition) and let AQE coalesce them to ~256 MB;
    # AQE only merges partitions, so the initial number must be high.
    # Skewed join partitions are split at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    # file splits sized so one task reads ~512 MB of parquet
    "spark.sql.files.maxPartitionBytes": str(512 << 20),
    # broadcast only small sides; AQE re-checks with measured sizes
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    # streaming state off-heap in RocksDB, changelog checkpoints
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_defaults(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """Set each of ``CLUSTER_CONF`` that the session does not already define
    (a cluster's own settings always win).  Also ensures the checkpoint
    folder (read from the session, created only if unset)."""
    for k, v in (conf or CLUSTER_CONF).items():
        if spark.conf.get(k, None) in (None, ""):
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static conf on a running session: leave it
                pass
    ensure_checkpoint_dir(spark)
    return spark


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "stratum") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that ``spark.checkpoint.dir`` names.  Only a
    local session may go without: it gets a temporary folder.  On a cluster a
    machine-local folder would be invisible to the other machines, so an unset
    folder is an error there."""
    current = spark.conf.get(_CHECKPOINT_KEY, None)
    if not current:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = current.get() if current.isDefined() else None
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all machines share (master {master})")
        current = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, current)
    spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (optionally run-unique)."""
    base = ensure_checkpoint_dir(spark)
    segs = list(parts)
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join([base, "stratum"] + segs)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete everything that this library has written under the shared folder
    (intermediates, streaming checkpoints).  Call it when no frame that a query
    returned is still to be read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/stratum")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))
