"""Folder listings and file contents read inside tasks, through Arrow's file systems.

Spark's own file readers skip names that begin with '_' or '.'. Here tasks list folders and open
files themselves: no name or content passes through the driver, and a file that can't be read is
a row that says so. Work is in rounds: each task walks down from some folders until it has listed
a bounded number of entries and hands the folders that are left to the next round, so a tree of
any shape is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources.scratch import stage

#: Entries that a task lists before it hands folders on.
ENTRIES_PER_TASK = 20_000
#: Bytes of files that a task reads, and that it holds at once (or one file).
BYTES_PER_TASK = 64 << 20
BYTES_HELD = 8 << 20
#: What became of a file or folder. Fixed values.
LISTED, READ, UNREADABLE, OVERSIZED, FOLDER = "listed", "read", "unreadable", "oversized", "folder"


def arrow_path(path: str) -> tuple[str, str]:
    """Address of a file system for Arrow ('' for the local one) and the path on it."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        local = rest if colon else path
        return "", "/" + local.strip("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    place = rest.strip("/")
    if scheme in ("s3", "gs"):
        return f"{scheme}://{place.split('/')[0]}", place
    return f"{scheme}://{place.split('/')[0]}/", "/" + place.partition("/")[2]


def can_open(path: str) -> bool:
    """Whether Arrow has a file system for this path."""
    from pyarrow import fs

    address, _ = arrow_path(path)
    try:
        return not address or fs.FileSystem.from_uri(address) is not None
    except Exception:  # an unknown scheme, or a library of its own that isn't there
        return False


ENTRY = "path string, length bigint, hidden boolean, status string"


def walk(spark: SparkSession, root: str) -> DataFrame:
    """Every file below a folder: path relative to it, length, `hidden` (Spark's readers leave a name
    on the path out), status; staged.

    A folder that can't be listed is one row with the status 'unreadable'. Links are followed. A
    missing or empty folder gives no rows.
    """
    address, base = arrow_path(root)
    limit = ENTRIES_PER_TASK
    entry, folder_status, unreadable = (LISTED, FOLDER, UNREADABLE)

    def listed(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system = fs.FileSystem.from_uri(address)[0] if address else fs.LocalFileSystem()
        left = limit

        def unseen(name: str) -> bool:
            """Fixed rule: the names that Spark's file readers leave out."""
            kept = name.startswith(("_metadata", "_common_metadata")) or (name.startswith("_") and "=" in name)
            return name.startswith((".", "_")) and not kept or name.endswith("._COPYING_")

        def found(folder: str) -> list[tuple]:
            place = f"{base}/{folder}" if folder else base
            rows = []
            for info in system.get_file_info(fs.FileSelector(place, allow_not_found=True)):
                path = f"{folder}/{info.base_name}" if folder else info.base_name
                if info.type == fs.FileType.Directory:
                    rows.append((path, None, folder_status))
                elif info.type == fs.FileType.File:
                    rows.append((path, info.size, entry))
                else:
                    rows.append((path, None, unreadable))
            return rows

        for batch in batches:
            folders, out = batch.column(0).to_pylist(), []
            while folders:
                folder = folders.pop()
                if left <= 0:
                    out.append((folder, None, folder_status))
                    continue
                try:
                    rows = found(folder)
                except OSError:
                    rows = [(folder, None, unreadable)]
                left -= len(rows) + 1
                folders += [path for path, _, status in rows if status == folder_status]
                out += [row for row in rows if row[2] != folder_status]
            hidden = [any(map(unseen, path.split("/"))) for path, _, _ in out]
            columns = [[r[0] for r in out], [r[1] for r in out], hidden, [r[2] for r in out]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "length", "hidden", "status"]
            )

    rounds = []
    folders = spark.range(1).select(F.lit("").alias("path"))
    while True:
        rounds.append(stage(folders.mapInArrow(listed, ENTRY), "listing"))
        folders = rounds[-1].filter(F.col("status") == FOLDER).select("path")
        if folders.isEmpty():
            break
        folders = folders.repartition(spark.sparkContext.defaultParallelism)
    return reduce(DataFrame.unionByName, rounds).filter(F.col("status") != FOLDER)


def read_listed(spark: SparkSession, root: str, listed: DataFrame, most_bytes: int) -> DataFrame:
    """Listed files with their bytes, see `contents`; staged."""
    return stage(contents(spark, root, listed, most_bytes), "contents")


def contents(spark: SparkSession, root: str, listed: DataFrame, most_bytes: int) -> DataFrame:
    """Listed files (path, length) with their bytes: path, content, status. They are read by whatever
    uses the table, whichever columns it needs, in tasks of bounded bytes and any number of files.

    Files above `most_bytes` and files that can't be opened have no content and a status that says
    so. A file is read by the task that holds its path, one at a time.
    """
    address, base = arrow_path(root)
    held, read, unreadable, oversized = BYTES_HELD, READ, UNREADABLE, OVERSIZED

    def opened(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system = fs.FileSystem.from_uri(address)[0] if address else fs.LocalFileSystem()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "content", "status"])

        for batch in batches:
            rows, size = [], 0
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if length is None or length > most_bytes:
                    rows.append((path, None, unreadable if length is None else oversized))
                    continue
                try:
                    with system.open_input_stream(f"{base}/{path}") as stream:
                        rows.append((path, stream.read(), read))
                except OSError:
                    rows.append((path, None, unreadable))
                size += length
                if size > held:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    total = listed.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    tasks = max(1, min(total["n"], max(spark.sparkContext.defaultParallelism, total["b"] // BYTES_PER_TASK)))
    spread = listed.select("path", "length").repartition(tasks)
    return spread.mapInArrow(opened, "path string, content binary, status string")
