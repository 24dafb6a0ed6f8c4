"""Writers. All write folders of JSON lines, one file per task, plain or compressed with a codec that
Spark's text writers know (such as gzip). Readers tell by the files' suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.functions import chat


def _writer(df: DataFrame, compression: str | None) -> DataFrameWriter:
    # The fastest level: texts shrink nearly as much, and the jobs wait less for it.
    return df.write.options(compression=compression or "none", **{"zlib.compress.level": "BEST_SPEED"})


def write_split(examples: DataFrame, path: str, compression: str | None = None) -> None:
    """Training and validation rows below split=train and split=val. Rows that came as a line
    of their own (`raw`) are written as that line, with all its fields."""
    if "raw" not in examples.columns:
        _writer(examples.select("split", "conversations"), compression).partitionBy("split").json(path)
        return
    line = F.coalesce("raw", F.to_json(F.struct("conversations")))
    _writer(examples.select("split", line.alias("value")), compression).partitionBy("split").text(path)


def write_units(units: DataFrame, path: str, compression: str | None = None) -> None:
    _writer(units.select(*schemas.UNIT_SINK_COLUMNS), compression).json(path)


def write_messages(examples: DataFrame, path: str, compression: str | None = None) -> None:
    """The split in role/content form; validation rows go below split=valid."""
    name = F.when(F.col("split") == "val", F.lit("valid")).otherwise(F.col("split"))
    shown = examples.select(name.alias("split"), chat.to_messages(F.col("conversations")).alias("messages"))
    _writer(shown, compression).partitionBy("split").json(path)


def write_text(examples: DataFrame, path: str, compression: str | None = None) -> None:
    """The split as rendered text rows."""
    rendered = examples.select("split", chat.render(F.col("conversations")).alias("text"))
    _writer(rendered, compression).partitionBy("split").json(path)
