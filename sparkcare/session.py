"""Session helpers.

Library functions never build their own session: they take the caller's
``SparkSession`` (or a DataFrame and use ``df.sparkSession``).  ``local_session``
is for tests, the bench and the examples only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.driver.host": "127.0.0.1",
}


def local_session(cpus: int | str = "*", app: str = "sparkcare", memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.driver.memory", memory)
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without that setting gets a
    fresh folder of its own, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so lineage can be cut reliably")
        configured = tempfile.mkdtemp(prefix="sparkcare-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_stored: list[str] = []


def clear_stored(spark: SparkSession) -> int:
    """Delete the tables that ``stored_copy`` has written in this process, when the results that
    read them have been used; how many there were."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = 0
    while _stored:
        path = hadoop.Path(_stored.pop())
        gone += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def stored_copy(df: DataFrame) -> DataFrame:
    """``df`` written once as a parquet table under the session's reliable
    checkpoint folder and read back: the lineage is cut like ``checkpoint()``, but
    the data is computed by a single write job, stored columnar and compressed, and
    the planner sees file sizes (for join strategy) when it is read again.  The table stays until
    ``clear_stored`` or until the folder is cleared."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    _stored.append(path)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
