"""Small files and folders of a table on the shared file system, with a commit that only one writer can make."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    fs, place = _path(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(place)] if fs.exists(place) else []


def finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers N of the folders `name=N` below `path` whose writing has ended."""
    fs, _ = _path(spark, path)
    found = []
    for folder in names(spark, path):
        kind, _, number = folder.partition("=")
        if kind == name and number.lstrip("-").isdigit() and fs.exists(_path(spark, f"{path}/{folder}/_SUCCESS")[1]):
            found.append(int(number))
    return found


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _path(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _path(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole text at `path` in one step, unless something is there already: False, and nothing is changed.

    The text is written aside and moved without overwriting, as streaming checkpoints do.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(option, 1)
    options[0] = option.NONE
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), options)
    except Exception as failure:
        fs.delete(aside, False)
        if fs.exists(target):
            return False
        raise failure
    return True


def copies(spark: SparkSession, source: str, targets: list[str]) -> None:
    """Copies of a small file, one under each target name."""
    fs, place = _path(spark, source)
    for target in targets:
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, place, fs, _path(spark, target)[1], False, spark._jsc.hadoopConfiguration())
