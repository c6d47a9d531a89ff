"""Session helpers shared by tests, the bench and the driver entry points.

Library code never builds its own session: every operator takes DataFrames
and uses ``df.sparkSession``. These helpers only exist for local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ludica") -> SparkSession:
    """A local session tuned for small scale factors (tests, bench).

    AQE stays on so shuffle partitions coalesce and skewed joins split at
    run time; the UI is off (no server); a checkpoint directory is set only
    when the caller did not configure one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


#: Bytes of a batch that goes to a Python worker: the workers of an executor
#: hold a few batches each, however long the texts are.
ARROW_BATCH_BYTES = 8 << 20


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context, and bound the
    batches that go to their Python workers.

    Python workers unpickle UDFs by import, and they neither share the
    driver's ``sys.path`` nor its working folder, so the package goes along as
    a zip through Spark's own file distribution. A package that was already
    submitted as a zip (``--py-files``) is left to that.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_ludica_shipped", False) or not os.path.isdir(package):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="ludica-code-"), "ludica-code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("ludica", os.path.relpath(path, package)))
    sc.addPyFile(target)
    sc._ludica_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used as is. Only local runs (tests, bench) fall back to a fresh
    folder under the system temp dir.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                           "(HDFS, object store); a machine-local folder is not reliable")
    scratch = tempfile.mkdtemp(prefix="ludica-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint root for written tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
