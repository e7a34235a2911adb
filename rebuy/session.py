"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. Timestamps stay TIMESTAMP_NTZ end to end,
# so results do not depend on the session time zone; UTC is pinned anyway
# for anything a user casts.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "rebuy",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if master and master.startswith("local"):
        # local mode: the driver is the only JVM
        b = b.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only when the
    setting is unset and the master is local (tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="rebuy-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and continue
    from it (cuts lineage, survives lost executors, later scans prune
    columns). Used where one result feeds several branches of a plan."""
    spark = df.sparkSession
    path = shared_path(spark, f"{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Delete every table this application wrote with ``materialize``. Call it
    when no result that stands on them is needed any more."""
    remove(spark, shared_path(spark, spark.sparkContext.applicationId))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
