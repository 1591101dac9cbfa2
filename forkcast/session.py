"""Spark session helpers.

The session is configured for Catalyst/AQE to do the physical planning:
adaptive execution coalesces small shuffle partitions, splits skewed join
partitions and converts sort-merge joins to broadcast joins only when the
runtime size of a side is under ``spark.sql.autoBroadcastJoinThreshold``
(the size check behind every broadcast we do not hint ourselves).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "forkcast",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` is only set when given, so on a cluster the submit-time
    master wins.  ``shuffle_partitions`` should be sized to the data
    (roughly input bytes / 128 MB) on a cluster; AQE coalesces from there.
    """
    b = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            conf["spark.driver.memory"] = os.environ.get("FORKCAST_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store); it is read from the session and never replaced.  Only a
    local master without the setting gets a fresh scratch folder (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="forkcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def materialize(df, name: str = "stage", schema=None):
    """Cut lineage by writing ``df`` as parquet under the reliable
    checkpoint folder and reading it back (under ``schema`` if given).

    One computation (``Dataset.checkpoint`` runs the plan twice unless it
    is cached first); the files sit in the shared folder the cluster names,
    so a lost executor re-reads them instead of recomputing the lineage.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/forkcast-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


_WRITTEN: list[str] = []


def scratch_mark() -> int:
    """Position in the list of written intermediate tables (see ``release``)."""
    return len(_WRITTEN)


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables written since ``since`` (a
    ``scratch_mark()``), through the cluster's file system API.  Call it
    once the job's own outputs are written: DataFrames that still read
    those tables must not be used afterwards.  Returns the count deleted."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while len(_WRITTEN) > since:
        path = _WRITTEN.pop()
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).delete(p, True):
            done += 1
    return done
