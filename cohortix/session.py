"""Spark session helpers.

The library never creates its own cluster settings beyond what a local test
needs: on a cluster the caller's session (and its ``spark.checkpoint.dir``)
is used as is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(master: str | None = None, app: str = "cohortix") -> SparkSession:
    """Session for tests and benches (``local[N]``); reuses an active one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.master(master or "local[8]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    Order: the context's directory, then ``spark.checkpoint.dir`` from the
    session conf (the shared folder a cluster names), then - in local mode
    only - a fresh temporary folder. On a cluster without a configured shared
    folder this raises instead of writing to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so lineage can be cut safely"
        )
    path = tempfile.mkdtemp(prefix="cohortix-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def stored(df: DataFrame, path: str | None = None) -> tuple[DataFrame, str]:
    """The rows of ``df`` from a compressed table that is written to ``path``, a new folder below the
    checkpoint folder if that is None; and the folder."""
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    sweep(spark)
    return spark.read.schema(df.schema).parquet(path), path


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner see which shuffles are no longer needed, so that it drops their files now."""
    spark.sparkContext._jvm.System.gc()


def drop_stored(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it (else they use an installed one)."""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
