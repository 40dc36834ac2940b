"""Spark session defaults and the shared checkpoint folder.

Everything here is plain Spark configuration: ANSI SQL, UTC session time,
adaptive query execution (runtime broadcast conversion, partition coalescing,
skew-join splitting) and the UI off.  A cluster launcher normally sets these;
``configure`` only fills in what is unset.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins against a side measured at runtime below this size become
    # broadcast joins; bigger sides keep the shuffle join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.parquet.filterPushdown": "true",
    # Parse every CSV field even when a query reads few columns: with pruning
    # on, a row with too many fields passes as good under a narrow projection.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}

# Settings results depend on: always applied, even over a launcher's value.
SEMANTIC = ("spark.sql.ansi.enabled", "spark.sql.session.timeZone", "spark.sql.csv.parser.columnPruning.enabled")


# Sizing for a large cluster (~100 TB of raw input, ~1000 executors).  The
# largest shuffles (items to orders, items to sellers) carry a good share of
# the data; starting from many partitions and letting AQE coalesce them to
# ~256 MB keeps every task's shuffle block in memory-sized pieces (and
# spillable), while skewed partitions above 5x the median and 1 GB are split.
CLUSTER = {
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1GB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.files.openCostInBytes": "8MB",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession, scale: str = "local") -> SparkSession:
    """Apply the defaults that are not already set on a running session
    (``scale="cluster"`` adds the ``CLUSTER`` sizing, again only where unset)."""
    conf = spark.conf
    extra = CLUSTER if scale == "cluster" else {}
    own_bound = conf.get("spark.sql.autoBroadcastJoinThreshold", None) is not None
    for key, value in {**DEFAULTS, **extra}.items():
        if own_bound and key == "spark.sql.adaptive.autoBroadcastJoinThreshold":
            continue  # a launcher that bounds broadcasts means the runtime ones too
        if key in SEMANTIC:
            conf.set(key, value)
        elif conf.get(key, None) is None:
            conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "martforge",
                  event_log_dir: str | None = None, checkpoint: str | None = None) -> SparkSession:
    """A local session for tests, the bench and the smoke check."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged intermediates.

    Taken from ``spark.checkpoint.dir`` (a static setting, applied by Spark at
    start-up).  Only a local-mode session (tests, bench) may fall back to a
    fresh temporary folder; on a cluster the setting must point at shared
    storage, so its absence is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    value = sc.getConf().get("spark.checkpoint.dir", None)
    if not value:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        value = tempfile.mkdtemp(prefix="martforge-ckpt-")
    sc.setCheckpointDir(value)
    return sc.getCheckpointDir()


#: Spark deletes an action's shuffle files when the action ends, not when the driver collects garbage
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Steps that each write what the next one reads: within this, the shuffle files of a
    finished step leave the disk at once, so a run holds those of one step at a time.
    A launcher's own setting stays as it is."""
    before = spark.conf.get(RELEASE_SHUFFLES, None)
    if before is None:
        spark.conf.set(RELEASE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_SHUFFLES)
