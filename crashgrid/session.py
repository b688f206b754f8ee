"""Session helpers.

The library never creates a session behind the caller's back; these helpers
only build one for tests, the bench and the command line, and make sure the
settings the library relies on are present.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans are written for. AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew-join splits a hot partition of the
# large side so one key holding a third of the rows does not end up in one task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "crashgrid",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs (tests, bench). On a cluster, submit with your own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # checkpointed cubes of earlier runs are deleted once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**RUNTIME_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the runtime SQL options the plans assume, where the submitter has not
    set them (idempotent)."""
    given = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in given:
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is used as is. Only when it is unset is a fallback taken: the
    given one, or -- in local mode only -- a fresh temp folder. A cluster
    without a configured folder is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if fallback:
            configured = fallback
        elif sc.master.startswith("local"):
            configured = tempfile.mkdtemp(prefix="crashgrid-ckpt-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
