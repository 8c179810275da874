"""Sessions whose Python workers can import this package, and the shared folder in which steps are written."""

from __future__ import annotations

import tempfile
import uuid
from hashlib import sha256
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
_OWN = "spark.weekloom.folder"


def prepare(spark: SparkSession) -> SparkSession:
    """Puts the package's folder on the import path of Python workers. On a cluster, ship it with --py-files instead."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, ROOT])
    return spark


def local(cpus: int, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder that driver and executors share, spark.checkpoint.dir.

    Where that is unset, a single process may use a folder of its own; a cluster may not, as no two machines see it.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(_OWN, None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="weekloom-")
        spark.conf.set(_OWN, folder)
    return f"{folder.rstrip('/')}/weekloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there, and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names within a folder; none if it isn't there."""
    files, at = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


def state_of(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of all files of a table, in folders of partitions too: another text once any was written anew.

    The text is a digest, so it stays small for any number of files.
    """
    files, at = _file_system(spark, path)
    found = files.listFiles(at, True)
    seen = []
    while found.hasNext():
        s = found.next()
        seen.append(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}")
    return sha256("\n".join(sorted(seen)).encode()).hexdigest()


def clear(spark: SparkSession) -> None:
    """Deletes all that this application has stored. Results that still read it must have been written before."""
    delete(spark, shared_folder(spark))
