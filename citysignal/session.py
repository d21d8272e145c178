"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: keys are rendered in UTC, skew is handled at run time."""
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "citysignal", cores: int | str = "*", shuffle_partitions: int | None = None
) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster pass your own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, since there the
    driver and the executors are one process on one machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="citysignal-")
    return _LOCAL_DIRS[context.applicationId]


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or cleared."""
    return f"{shared_dir(spark)}/citysignal/{purpose}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint of ``df`` in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
