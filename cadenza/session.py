"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from measured stage sizes
# (broadcast below the threshold, sort-merge above it), splits skewed join
# partitions and merges small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "cadenza",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the settings above where the caller has set none.

    ``conf`` wins over what is configured elsewhere (spark-defaults, --conf, an
    active session), which wins over ``DEFAULT_CONF``. The web UI and the log
    level are left to the caller.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(conf or {})
    if shuffle_partitions is not None:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    active = SparkSession.getActiveSession()
    if active is None:
        # start the JVM first: what spark-submit or spark-defaults set is known there
        SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(settings.items()))
        given = dict(SparkConf().getAll())
    else:
        given = {**dict(active.sparkContext.getConf().getAll()), **active.conf.getAll}
    for key, value in DEFAULT_CONF.items():
        if key not in settings and key not in given and (
                active is None or active.conf.isModifiable(key)):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (missing, it is an error). Only in local mode with nothing configured
    (tests) a scratch folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors "
            "(stored intermediate tables and model checkpoints go there)")
    scratch = tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()
