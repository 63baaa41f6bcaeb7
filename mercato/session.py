"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every mercato job relies on.  Timestamps are TIMESTAMP_NTZ and all
# day/month arithmetic assumes a UTC session; AQE re-plans joins and
# coalesces shuffle partitions at runtime; ANSI stays on (Spark 4 default).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "mercato",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with mercato's base configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Local mode runs every task inside the driver JVM; this only takes
        # effect when the JVM is launched by this call.
        conf.setdefault("spark.driver.memory", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, or a folder of the warehouse where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/mercato-checkpoints").rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point reliable checkpoints at the cluster's shared folder.

    The cluster names its shared folder in ``spark.checkpoint.dir``; it is
    used as is.  Without that setting the session's warehouse, which a cluster
    shares as well, gets a folder for them; no folder of a single machine is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(shared_folder(spark))
    return sc.getCheckpointDir()
