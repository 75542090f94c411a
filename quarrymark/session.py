"""A session with settings that suit these operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("quarrymark")
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver deletes when it ends; unset on a cluster is an error, and locally gives a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path
