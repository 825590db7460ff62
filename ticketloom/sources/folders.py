"""Folders on any file system that Spark can reach, without opening their files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _path(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    place, system = _path(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def matching(spark: SparkSession, glob: str, hidden: bool = False) -> list[tuple[str, int, int]]:
    """(path, modification time in ms, length) of the files a glob matches."""
    place, system = _path(spark, glob)
    found = system.globStatus(place) or []
    return sorted(
        (status.getPath().toString(), status.getModificationTime(), status.getLen())
        for status in found
        if status.isFile() and (hidden or not status.getPath().getName().startswith(("_", ".")))
    )


def remove(spark: SparkSession, path: str) -> None:
    place, system = _path(spark, path)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    place, system = _path(spark, path)
    stream = system.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def first_lines(spark: SparkSession, path: str, complete: Callable[[bytes], bool]) -> bytes:
    """A file's beginning: as much of it as it takes to be ``complete``, or all of it."""
    place, system = _path(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
    stream = system.open(place)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        read = b""
        while not complete(read):
            more = bytes(plain.readNBytes(4096))
            if not more:
                break
            read += more
        return read
    finally:
        stream.close()


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, unless it exists already.

    Of several writers one succeeds: a local link, and a rename that does not replace, on
    file systems where renaming is atomic. Readers see nothing or all of it.
    """
    place, system = _path(spark, path)
    aside, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/_aside-{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if system.getScheme() == "file":
            os.link(aside.toUri().getPath(), place.toUri().getPath())
        else:
            hadoop = spark._jvm.org.apache.hadoop.fs
            keep = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
            keep[0] = hadoop.Options.Rename.NONE
            context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(context.makeQualified(aside), context.makeQualified(place), keep)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(aside, False)
