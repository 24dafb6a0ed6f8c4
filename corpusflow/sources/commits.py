"""Outputs that a later run replaces and a failed run leaves as they were.

A run writes all its parts into a staged folder inside the output folder. When they are complete, a
marker with the staged folder's name is written; from then on the parts are moved into place, one
by one, and whoever comes next finishes the moves if they were interrupted. Names that begin with
'_' are skipped by Spark's readers.

A rename is one step on file systems; on object stores it copies. Two runs into one folder at the
same time are not supported.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

STAGED, MARKER = "_staged-", "_commit-"


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_class = spark._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self.system = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.path_class(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.system.exists(self.at(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(self.at(name)))

    def remove(self, name: str) -> None:
        self.system.delete(self.at(name), True)

    def move(self, source: str, target: str) -> None:
        self.remove(target)
        if not self.system.rename(self.at(source), self.at(target)):
            raise OSError(f"could not move {self.at(source)} to {self.at(target)}")

    def touch(self, name: str) -> None:
        self.system.create(self.at(name), True).close()


def settle(spark: SparkSession, out: str) -> None:
    """Finish the moves of a run that was interrupted after its parts were complete."""
    folder = Folder(spark, out)
    for marker in [n for n in folder.names() if n.startswith(MARKER)]:
        staged = STAGED + marker.removeprefix(MARKER)
        for part in folder.names(staged):
            folder.move(f"{staged}/{part}", part)
        folder.remove(staged)
        folder.remove(marker)


@contextlib.contextmanager
def replacing(spark: SparkSession, out: str) -> Iterator[str]:
    """A folder to write the parts of an output to; they replace those of `out` in the end.

    Parts that this run doesn't write stay. If the run fails, nothing in `out` has changed.
    """
    settle(spark, out)
    folder, run = Folder(spark, out), uuid.uuid4().hex
    try:
        yield f"{folder.root}/{STAGED}{run}"
    except BaseException:
        folder.remove(STAGED + run)
        raise
    folder.touch(MARKER + run)
    settle(spark, out)
