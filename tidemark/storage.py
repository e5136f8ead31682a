"""Paths: the shared scratch folder and the few directory operations Spark
has no DataFrame call for. All go through the Hadoop file system API, so they
work on any store the cluster can read."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession


# The folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only on a local master that sets none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _resolve(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _resolve(spark, path)
    return fs.exists(handle)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, handle = _resolve(spark, path)
    fs.mkdirs(handle)


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, handle = _resolve(spark, path)
    fs.delete(handle, True)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob; empty when nothing does."""
    fs, handle = _resolve(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(handle) or [])


def files(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Paths matching a glob, with their lengths."""
    fs, handle = _resolve(spark, pattern)
    return {status.getPath().toString(): status.getLen() for status in fs.globStatus(handle) or []}


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, handle = _resolve(spark, path)
    if not fs.rename(handle, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all."""
    fs, handle = _resolve(spark, f"{path}.new")
    out = fs.create(handle, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    rename(spark, f"{path}.new", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, handle = _resolve(spark, path)
    source = fs.open(handle)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, handle = _resolve(spark, path)
    return fs.getContentSummary(handle).getLength() if fs.exists(handle) else 0


def partition_dir(path: str, column: str, value) -> str:
    name = NO_VALUE if value is None else str(value)
    return f"{path}/{column}={name}"


def any_partition(spark: SparkSession, path: str, column: str) -> bool:
    """Whether a table has a partition, without listing all of them."""
    fs, handle = _resolve(spark, path)
    if not fs.exists(handle):
        return False
    entries = fs.listStatusIterator(handle)
    while entries.hasNext():
        if entries.next().getPath().getName().startswith(f"{column}="):
            return True
    return False


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Directory values of one partition column (the catalog's own listing)."""
    prefix = f"{column}="
    names = (p.rsplit("/", 1)[1] for p in glob(spark, f"{path}/{prefix}*"))
    return [name[len(prefix):] for name in names]


def file_signatures(spark: SparkSession, path: str, column: str) -> dict[str | None, str]:
    """For each value of a partition column a digest of the names, lengths and
    times of its data files."""
    fs, _ = _resolve(spark, path)
    found: dict[str | None, list[str]] = {}
    handle = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*/[!_.]*")
    for status in fs.globStatus(handle) or []:
        file = status.getPath()
        value = file.getParent().getName().removeprefix(f"{column}=")
        key = None if value == NO_VALUE else value
        found.setdefault(key, []).append(f"{file.getName()}:{status.getLen()}:{status.getModificationTime()}")
    return {key: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for key, files in found.items()}
