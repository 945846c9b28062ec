"""Session set-up, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def build_session(master: str = "local[8]", shuffle_partitions: int = 8) -> SparkSession:
    """A session with the settings the operators are written for (AQE on, UTC, zstd Parquet)."""
    return (
        SparkSession.builder.master(master)
        .appName("loomspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.driver.memory", os.environ.get("LOOM_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed on them: by path on one machine, as an archive on a cluster."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        env = context.environment
        paths = env.get("PYTHONPATH", "")
        if ROOT not in paths.split(os.pathsep):
            env["PYTHONPATH"] = ROOT + (os.pathsep + paths if paths else "")
    elif context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="loomspark-archive-")  # read by the driver alone, which serves it to the executors
        context.addPyFile(shutil.make_archive(f"{folder}/loomspark", "zip", ROOT, "loomspark"))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its scan has fewer splits than that, as a table of one small file has; else as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The application's part of the folder all executors share, ``spark.checkpoint.dir``.

    On one machine a temporary folder serves where that is unset; on a cluster it must be set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if folder:
        return f"{folder.rstrip('/')}/loomspark-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="loomspark-")
    return _own_folders[app]


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as the JVM sees them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def clean_up(spark: SparkSession) -> None:
    """Delete what this application materialized. Results that still read it can't be used afterwards."""
    p, fs = hadoop_path(spark, shared_folder(spark))
    fs.delete(p, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it once into the shared folder and reading it back.

    Used where one result feeds several later branches, so that it is neither computed twice nor lost with an executor.
    The tables stay until ``clean_up``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
