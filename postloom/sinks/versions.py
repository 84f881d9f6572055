"""Numbered versions of a table's folder.

A writer claims a number by creating an empty file that must not exist yet, writes
``version=<number>``, and then marks the number done the same way. Readers take the
highest number that is done: neither a clock nor a half-written version decides, and two
writers never share a number.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    """A folder as Hadoop's file system and path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where there is one already."""
    system, place = _folder(spark, path)
    try:
        system.create(place, False).close()
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise
    return True


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the marks of one kind, ascending."""
    system, place = _folder(spark, f"{root}/log")
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(f".{kind}"))


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a write to a folder has ended well."""
    return exists(spark, f"{path}/_SUCCESS")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    system, place = _folder(spark, path)
    return system.exists(place)


def file_bytes(spark: SparkSession, files: list[str]) -> int:
    """Size of some files, named as ``DataFrame.inputFiles`` does."""
    total = 0
    for name in files:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        total += system.getFileStatus(place).getLen()
    return total


def claim_version(spark: SparkSession, root: str) -> int:
    """The next number, which no other writer gets."""
    number = max(_numbers(spark, root, "claimed"), default=0) + 1
    while not _create(spark, f"{root}/log/{number:012d}.claimed"):
        number += 1
    return number


def publish_version(spark: SparkSession, root: str, number: int) -> None:
    """Show a claimed version, whose folder is whole, to readers."""
    _create(spark, f"{root}/log/{number:012d}.done")


def done_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers that readers may see, ascending."""
    return _numbers(spark, root, "done")


def failed_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers that were claimed and are not done: failed, or still being written."""
    done = set(done_versions(spark, root))
    return [n for n in _numbers(spark, root, "claimed") if n not in done]


def forget_marks(spark: SparkSession, root: str) -> None:
    """Remove the marks of all versions that are done, but the newest one's."""
    for number in done_versions(spark, root)[:-1]:
        for kind in ("claimed", "done"):
            remove(spark, f"{root}/log/{number:012d}.{kind}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    system, place = _folder(spark, path)
    system.delete(place, True)


def version_folder(root: str, number: int) -> str:
    """Where the rows of a version lie."""
    return f"{root}/version={number}"


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, and what failed before them.

    Returns the numbers removed. Numbers claimed after the oldest kept version stay, as
    they may still be written. The marks of removed versions go first, so
    that a new reader never picks one whose files are half gone.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is read")
    done = done_versions(spark, root)
    if not done:
        return []
    oldest = done[-keep:][0]
    gone = [n for n in _numbers(spark, root, "claimed") if n < oldest]
    for number in gone:
        for path in (
            f"{root}/log/{number:012d}.done",
            version_folder(root, number),
            f"{root}/log/{number:012d}.claimed",
        ):
            remove(spark, path)
    return gone
