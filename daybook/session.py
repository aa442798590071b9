"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the job.

    In order: the folder already set on the context, ``spark.checkpoint.dir``,
    and, on a ``local`` master only, a fresh temporary folder. On a cluster
    without either it raises, because executors would write to their own disks.
    """
    sc = spark.sparkContext
    already = sc.getCheckpointDir()
    if already:  # Spark appends a folder of its own, still inside the shared one
        return already
    current = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="daybook-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a staged table through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``daybook`` importable in Python workers (UDFs, data sources).

    The package is zipped once per application and added with ``addPyFile``,
    the same thing ``spark-submit --py-files`` does on a cluster.
    """
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = tempfile.mkdtemp(prefix="daybook-pyfiles-")
    archive = shutil.make_archive(os.path.join(base, "daybook"), "zip", os.path.dirname(pkg), "daybook")
    sc.addPyFile(archive)
    _SHIPPED.add(app)
