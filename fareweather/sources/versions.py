"""Published tables as versions behind one pointer.

A table is a folder that holds versions, each written once and never changed, and a
small file that names the current one. Writing goes to a new version; only when it is
whole does the pointer move, by one atomic rename. So a stage that fails, or a job whose
executors are lost for good, leaves what readers use untouched, and a reader that has
begun on the old version ends on it. The last few versions are kept, older ones are
deleted after the pointer has moved.

A folder without a pointer is a plain table, so files from elsewhere are read alike.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

POINTER = "_current"
KEEP = 2

T = TypeVar("T")


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions below a path, oldest first."""
    place, files = _hadoop(spark, path)
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(name for name in names if name.startswith("v-"))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if it is not there."""
    place, files = _hadoop(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place as a whole: readers see the old or the new one."""
    jvm = spark.sparkContext._jvm
    folder, _, name = path.rpartition("/")
    place, files = _hadoop(spark, f"{folder}/_{uuid.uuid4().hex}")
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    renames = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(renames, 1)
    how[0] = renames.OVERWRITE
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    scheme = [place.toUri()] if place.toUri().getScheme() else []
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(*scheme, settings)
    context.rename(place, jvm.org.apache.hadoop.fs.Path(path), how)


def current(spark: SparkSession, path: str) -> str | None:
    """Name of the current version; None for a plain table or no table."""
    return read_text(spark, f"{path}/{POINTER}")


def resolve(spark: SparkSession, path: str) -> str:
    """Where the rows of a published table lie now."""
    name = current(spark, path)
    return f"{path}/{name}" if name else path


def stamp(spark: SparkSession, path: str) -> str | None:
    """What tells one state of a table or file from another; None if it is not there."""
    name = current(spark, path)
    if name:
        return name
    place, files = _hadoop(spark, path)
    if not files.exists(place):
        return None
    found, walk = [], files.listFiles(place, True)
    while walk.hasNext():
        file = walk.next()
        found.append((file.getPath().getName(), file.getLen(), file.getModificationTime()))
    return str(sorted(found))


def publish(spark: SparkSession, path: str, write: Callable[[str], T], keep: int = KEEP) -> T:
    """Let ``write`` fill a new version, make it the current one, drop old ones.

    Returns what ``write`` returned. If it raises, nothing that is published changes.
    Two publishers of one table do not mix rows; the pointer names the one that ended
    last.
    """
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        made = write(f"{path}/{name}")
    except Exception:
        place, files = _hadoop(spark, f"{path}/{name}")
        files.delete(place, True)
        raise
    write_text(spark, f"{path}/{POINTER}", name)
    # Versions after this one belong to publishers that have not ended yet.
    older = [v for v in _versions(spark, path) if v < name]
    for old in older[: max(0, len(older) - (keep - 1))]:
        place, files = _hadoop(spark, f"{path}/{old}")
        files.delete(place, True)
    return made
