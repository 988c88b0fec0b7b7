"""Session helpers: a local session for tests/bench, and the shared scratch root.

On a cluster the scratch root is whatever ``spark.checkpoint.dir`` names (a
shared filesystem); we only pick our own folder when it is unset (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint root, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share (master {sc.master})")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    return sc.getCheckpointDir()


_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint root, in a folder of this application that goes
    when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        root = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "ledgerline", app])
        place = spark._jvm.org.apache.hadoop.fs.Path(root)
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(place)
        store.deleteOnExit(place)
        _roots[app] = root
    return "/".join([_roots[app], *parts, uuid.uuid4().hex])


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def cluster_settings(input_bytes: int, executor_cores: int = 4, executor_memory_gb: int = 16) -> dict[str, str]:
    """Session settings sized for a large cluster, derived from the input size.

    * scan splits of 512 MB: 100 TB -> ~200k tasks, each far below an executor's memory;
    * an initial shuffle width of about 1 GB per partition (a setting only, held within 200..200,000: more
      reduce tasks cost more than larger ones), which AQE coalesces toward 512 MB partitions at runtime
      and splits further when a partition is skewed;
    * a 64 MB broadcast threshold only for sides Spark has measured (AQE re-plans on real sizes);
    * UTC sessions, so wall-clock fields never depend on where a job runs.
    """
    gib = 1 << 30
    shuffle = max(200, min(200_000, -(-int(input_bytes) // gib)))
    per_core_mb = executor_memory_gb * 1024 // max(1, executor_cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": "512m" if per_core_mb >= 2048 else "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }
