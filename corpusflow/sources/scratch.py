"""Shared folder for staged tables, stream checkpoints and round trips."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder the session names.

    Without the setting only a local session gets a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="corpusflow-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _open_scopes:
        made.append(path)
    return path


_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove every scratch folder made within, once all that reads it has been written."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a DataFrame once and read it back.

    Later steps then share one computation, and lost executors cost no recomputation. Tables of
    long texts are smaller with a `compression` (of Parquet) other than the session's.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
