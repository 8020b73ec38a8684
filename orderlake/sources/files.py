"""Files of the shared store by name: listed, read, put in place, removed. Rows never pass through here."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _store(spark, path).exists(_path(spark, path))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    return _store(spark, path).getContentSummary(_path(spark, path)).getLength()


def list_names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names in a folder and when each was last changed (ms); none if there is no such folder."""
    if not exists(spark, folder):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in _store(spark, folder).listStatus(_path(spark, folder))]


def remove(spark: SparkSession, path: str) -> None:
    _store(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _store(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; false if there is one of that name already."""
    gateway = spark.sparkContext._gateway
    fs = gateway.jvm.org.apache.hadoop.fs
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    out = _store(spark, hidden).create(_path(spark, hidden), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = fs.FileContext.getFileContext(_path(spark, path).toUri(), conf)
    never_over = getattr(fs, "Options$Rename").NONE
    options = gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = never_over
    try:
        context.rename(_path(spark, hidden), _path(spark, path), options)
    except Exception:
        remove(spark, hidden)
        if exists(spark, path):
            return False
        raise
    return True
