"""What the operators share: worker imports, row keys of queries, batches of bounded size."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable_on_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies at the same place as on the driver.

    On a cluster without such a folder install the package or pass it with --py-files.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


#: Rows and bytes that a Python worker gets at once. Spark's default of 10,000 rows suits short rows.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "500"),
    "spark.sql.execution.arrow.maxBytesPerBatch": (None, "8m"),
}


def prepare(spark: SparkSession) -> None:
    """Make workers ready for texts. Settings that the user changed stay as they are."""
    importable_on_workers(spark)
    for name, (default, value) in BATCH_SETTINGS.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)


#: Memory that a Python worker has freed goes back to the machine at once.
LEAN_ENVIRONMENT = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
    "MALLOC_MMAP_THRESHOLD_": "262144",
}


def prepare_lean(spark: SparkSession) -> None:
    """`prepare` for several operators in one session. Workers live on from one to the next, beside
    a heap that doesn't shrink either, and by default keep what they have freed. Giving it back
    costs time, so an operator by itself does without. What the user has set stays as it is."""
    prepare(spark)
    for name, value in LEAN_ENVIRONMENT.items():
        spark.sparkContext.environment.setdefault(name, value)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`. Null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to at most `most`, or that hold one item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A side of a join up to this size (as written to Parquet) goes to every worker.
BROADCAST_BYTES = 16 << 20


def is_small(table: DataFrame) -> bool:
    """Whether a staged table may be broadcast, by the size of its files."""
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= BROADCAST_BYTES


def packed(docs: DataFrame, *shown: str) -> DataFrame:
    """All columns in one, `given`, beside those in `shown`: nothing that is added later can clash
    with a name of theirs."""
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in shown], F.lit(0).alias(" "))
    return docs.select(given.alias("given"), *shown)


def unpacked(df: DataFrame, docs: DataFrame, **fresh: Column) -> list[Column]:
    """The columns of `docs`, from a table made of `packed(docs, …)`; those in `fresh` are new."""
    return [
        (fresh[c] if c in fresh else F.col(c) if c in df.columns and c != "given" else F.col("given").getField(c)).alias(c)
        for c in docs.columns
    ]
