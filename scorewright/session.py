"""Session helpers.

On a cluster the session is built by the platform; the library only *reads*
its settings.  ``local_session`` is for tests and the bench: it sets a
checkpoint folder only when none is configured.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# "parquet" (default): columnar table in the checkpoint folder; "checkpoint": DataFrame.checkpoint()
MATERIALIZE_KEY = "spark.scorewright.materialize"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "scorewright") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SCOREWRIGHT_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as-is.  Only a session without the setting (tests,
    local bench) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="scorewright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """The application's own folder for stored tables, in the shared checkpoint folder.
    It is dropped when the driver ends in the usual way."""
    path = f"{ensure_checkpoint_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    if path not in _scratch:
        _scratch.add(path)
        atexit.register(drop_folder, spark, path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system; a stopped session leaves it."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df):
    """Write ``df`` once as a parquet table in the shared checkpoint folder and
    read it back.

    For multi-pass work (fit statistics, then apply; several metric passes) the
    source plan - here joins over the fact tables - runs once instead of once per
    pass.  The lineage is cut: a lost executor re-reads the table instead of
    recomputing the joins.  Parquet rather than ``DataFrame.checkpoint()``: later
    passes read only the columns they use (pruning and pushdown work on it).
    Never ``localCheckpoint``: its blocks die with the executor.
    """
    spark = df.sparkSession
    if spark.conf.get(MATERIALIZE_KEY, "parquet") == "checkpoint":
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
