"""Session helpers: a local session for tests/benchmarks and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "crease", driver_memory: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a scratch folder; a cluster
    without it is an error, since a machine-local folder would not survive
    the loss of an executor.  The setting itself is taken as given: only the
    cluster knows which of its folders are shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server applies its own setting
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from None
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not _is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="crease-ckpt-")
    sc.setCheckpointDir(path)
    return path
