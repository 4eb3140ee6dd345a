"""Session settings the operators rely on, and the shared folder for derived tables."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Runtime settings only: they can be changed on a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Shuffled data one task should get before adaptive execution merges or splits partitions.
BYTES_POR_PARTICION = 64 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the initial number of shuffle partitions by the size of the input, unless the session sets it.

    The fixed default suits neither tiny nor huge inputs. Adaptive execution merges partitions that turn out
    small, so erring high is cheap; a partition that does not fit in memory spills.
    """
    clave, propia = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.fogon.initialPartitionNum"
    actual, nuestra = spark.conf.get(clave, None), spark.conf.get(propia, None)
    if actual is not None and actual != nuestra:
        return int(actual)
    particiones = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // BYTES_POR_PARTICION), int(nuestra or 0))
    if particiones > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(clave, str(particiones))
        spark.conf.set(propia, str(particiones))
    return particiones


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fogon")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="fogon-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Put this package on the executors' Python path, once per application.

    Functions of the package are pickled by reference, so Python workers that do not share the driver's file system
    need the code itself. Spark serves the archive to every executor, present and future.
    """
    context = spark.sparkContext
    if getattr(context, "_fogon_shipped", False):
        return
    paquete = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="fogon-package-"), "fogon_package")
    context.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(paquete), os.path.basename(paquete)))
    context._fogon_shipped = True
