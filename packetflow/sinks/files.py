"""Small files of the shared folder, written and read by the driver through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    p, fs = hadoop_path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (ASCII) that is there as a whole or not at all."""
    p, fs = hadoop_path(spark, path)
    part, _ = hadoop_path(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.writeBytes(text)
    out.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
