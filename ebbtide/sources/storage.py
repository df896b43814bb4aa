"""Small file-system calls that Spark has no DataFrame form for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _open_fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open_fs(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str, within: str) -> bool:
    """Delete a path, which must lie below ``within``."""
    if not path.startswith(within.rstrip("/") + "/") or ".." in path.split("/"):
        raise ValueError(f"refusing to delete {path!r}: not below {within!r}")
    fs, hadoop_path = _open_fs(spark, path)
    return fs.exists(hadoop_path) and fs.delete(hadoop_path, True)


def list_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names directly below a directory that match a regular expression."""
    fs, hadoop_path = _open_fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    jvm = spark._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(hadoop_path))
    # One call for the whole listing instead of one per entry.
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)
    return sorted(re.findall(rf"/({pattern})(?=[,}}])", text))


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open_fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; fails if it is already there.

    The text is written under another name and renamed, so a reader sees the
    whole file or none, and a lost writer leaves nothing under the real name.
    """
    folder, _, name = path.rpartition("/")
    fs, draft = _open_fs(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), no_options)
    finally:
        fs.delete(draft, False)


def replace_file(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file over another in one step: a reader sees the old or the new one.

    Files of mounted folders are moved by the operating system: Hadoop's local file
    system deletes the old one first.
    """
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    fs, source = _open_fs(spark, path)
    source, destination = fs.makeQualified(source), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target))
    fs.mkdirs(destination.getParent())
    if fs.getUri().getScheme() == "file":
        how = new_array(jvm.java.nio.file.CopyOption, 1)
        how[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
        files = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (source, destination)]
        jvm.java.nio.file.Files.move(*files, how)
        return
    how = new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(source, destination, how)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to a path that is free; its parents are made."""
    fs, source = _open_fs(spark, path)
    destination = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(destination.getParent())
    if fs.exists(destination) or not fs.rename(source, destination):
        raise ValueError(f"cannot move {path!r} to {target!r}")


def modified(spark: SparkSession, path: str) -> float:
    """When a path was last modified, in seconds since 1970."""
    fs, hadoop_path = _open_fs(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def set_modified(spark: SparkSession, path: str, seconds: float) -> None:
    """Date a path, in seconds since 1970."""
    fs, hadoop_path = _open_fs(spark, path)
    fs.setTimes(hadoop_path, int(seconds * 1000), -1)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, modificationTime) of the Parquet files below some paths.

    Only the listing is used: file contents are pruned away.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .select("path", "length", "modificationTime")
    )


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """One row (numFiles, sizeInBytes) for the Parquet files below a path."""
    return list_files(spark, path).agg(
        F.count("*").alias("numFiles"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("sizeInBytes"),
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for working tables, in the cluster's shared folder.

    The shared folder is the session's ``spark.checkpoint.dir``. Where it is
    unset, a temporary folder is used if everything runs on one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ebbtide-")
    fs, hadoop_path = _open_fs(spark, shared)
    shared = hadoop_path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The same rows from a working table, for plans that use them several times.

    Unlike cached rows, these outlive executors, can be read by column, and
    have a size the planner knows.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
