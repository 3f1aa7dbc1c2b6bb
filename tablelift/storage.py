"""Small files and folders in any file system Spark can reach, seen from the driver."""

from __future__ import annotations

from pyspark.errors.exceptions.base import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Does a path or pattern name anything?"""
    files, where = _at(spark, pattern)
    return bool(files.globStatus(where))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    files, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there: False then.  Its text is seen as a whole or not at all."""
    files, where = _at(spark, path)
    if files.getUri().getScheme() == "file":
        return _create_local(spark, where, text)
    try:
        stream = files.create(where, False)
    except (Py4JJavaError, PySparkException):
        if files.exists(where):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def _create_local(spark: SparkSession, where, text: str) -> bool:
    """As :func:`create`.  Hadoop's local files look for a file before they open it, so two writers could both succeed.

    The name is taken first, empty; the text then replaces it in one rename, without checksums beside it.
    """
    files = spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration())
    files.mkdirs(where.getParent())
    if not files.pathToFile(where).createNewFile():
        return False
    files.getRaw().delete(files.getChecksumFile(where), False)  # left by a file that was here before
    hidden = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.new.crc")  # listings leave such names out
    stream = spark._jvm.java.io.FileOutputStream(files.pathToFile(hidden))
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if not files.getRaw().rename(hidden, where):
        raise OSError(f"{hidden} could not be renamed to {where}")
    return True


def read(spark: SparkSession, path: str) -> str:
    files, where = _at(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_if_there(spark: SparkSession, path: str) -> str | None:
    """As :func:`read`; None if the file is not there, or was removed since it was listed."""
    try:
        return read(spark, path)
    except (Py4JJavaError, PySparkException):
        if exists(spark, path):
            raise
        return None


def first_line(spark: SparkSession, name: str, block: int = 1 << 16) -> bytes | None:
    """The bytes of a file (a URI, as listings have it) before its first line feed, decompressed; None if it is empty."""
    where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
    settings = spark._jsc.hadoopConfiguration()
    stream = where.getFileSystem(settings).open(where)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(where)
    try:
        stream = codec.createInputStream(stream) if codec else stream
        found = b""
        while b"\n" not in found[-block:]:
            more = bytes(stream.readNBytes(block))
            found += more
            if not more:
                break
        return found.partition(b"\n")[0] if found else None
    finally:
        stream.close()


def move(spark: SparkSession, source: str, to: str) -> None:
    """Rename a file or folder to a name that is free."""
    files, where = _at(spark, source)
    there = _at(spark, to)[1]
    if files.exists(there):
        raise FileExistsError(to)
    if not files.rename(where, there):
        raise OSError(f"{source} could not be renamed to {to}")


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)
