"""Session settings and scratch space shared by the bench, the tests and batch jobs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "liftline", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared space the cluster names in ``spark.checkpoint.dir``.

    Only a session known to run on one machine (``local`` or ``local[...]``) falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "unknown")):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="liftline-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh scratch folder that is deleted at the end, also after a failure."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
