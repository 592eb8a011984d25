"""Session construction and the shared scratch area.

The scratch area lives under ``spark.checkpoint.dir``, which on a cluster
names a shared, fault-tolerant folder. Only when the session has no such
setting (local tests) do we create one.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Tuned for local[N]; on a cluster these come from the job's configuration.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their RDDs are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "marginflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    It is named by ``spark.checkpoint.dir``. Only a local session may do without:
    it gets a temporary folder; on a cluster a machine-local folder would lose
    data, so an unset folder is an error there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="marginflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_RUN_ID = uuid.uuid4().hex[:12]


_CLEANED: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    """Deletes this run's tables when the driver ends, if its session is still there."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop, True)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique path in the shared checkpoint folder for written stage tables."""
    base = ensure_checkpoint_dir(spark)
    if _RUN_ID not in _CLEANED:
        _CLEANED.add(_RUN_ID)
        atexit.register(_delete, spark, "/".join([base.rstrip("/"), "marginflow", _RUN_ID]))
    return "/".join([base.rstrip("/"), "marginflow", _RUN_ID, *parts])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the scratch area, read back: the lineage ends there, and
    its size is known when later joins are planned."""
    path = scratch_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "written", "local_path", "DEFAULT_CONF"]
