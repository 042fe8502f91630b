"""Small file-system questions through Hadoop's FileSystem, so any cluster storage works."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, path: str, directories: bool = False) -> list[str]:
    """Names directly below ``path``; empty if it does not exist."""
    if not exists(spark, path):
        return []
    found = _fs(spark, path).listStatus(_path(spark, path))
    return [s.getPath().getName() for s in found if s.isDirectory() or not directories]


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file unless it exists; of several writers exactly one succeeds.

    On a local disk the whole file is linked into place, which fails if the name is taken. Elsewhere the
    storage's own create-if-absent decides (HDFS, and object stores with conditional writes); a
    writer that dies in between leaves an unfinished file, which readers have to pass over.
    """
    fs, target = _fs(spark, path), _path(spark, path)
    fs.mkdirs(target.getParent())
    if fs.getScheme() == "file":
        local = target.toUri().getPath()
        draft = f"{local}.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, local)
        finally:
            os.unlink(draft)
        return
    try:
        out = fs.create(target, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
    except Py4JJavaError as failed:
        if fs.exists(target):
            raise FileExistsError(path) from failed
        raise


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def read_texts(spark: SparkSession, folder: str) -> dict[str, str]:
    """Small files directly below ``folder`` by name, read in one job."""
    if not exists(spark, folder):
        return {}
    rows = spark.read.text(folder, wholetext=True).select("_metadata.file_name", "value").collect()
    return {r[0]: r[1] for r in rows}
