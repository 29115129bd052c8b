"""Small files and folders, through the file systems that Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if there is no folder."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(place))


def partitions(spark: SparkSession, path: str, by: str) -> list[str]:
    """The values of a dataset's partition folders ``<by>=<value>``, in order; no data is read."""
    return [n[len(by) + 1 :] for n in names(spark, path) if n.startswith(f"{by}=")]


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which a file or folder was last changed."""
    fs, place = _at(spark, path)
    return fs.getFileStatus(place).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder; no data is read."""
    fs, place = _at(spark, path)
    return fs.getContentSummary(place).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that must not exist yet: whole, or not at all.

    Of several writers of one path one succeeds; the others get False.
    """
    folder, name = path.rsplit("/", 1)
    fs, draft = _at(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    fs_package = spark._jvm.org.apache.hadoop.fs
    context = fs_package.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    try:
        # Without the option to overwrite, a rename onto an existing file fails.
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(draft, fs_package.Path(path), options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True
