"""Incremental normalisation of landed rows and live metrics of training logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusflow.config import CorpusConfig
from corpusflow.operators import filters, logs, normalize
from corpusflow.sources import rows
from corpusflow.sources.scratch import scratch_dir


def normalize_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    style: str,
    config: CorpusConfig,
    origin: str,
    key: str,
    filter_field: str | None = None,
    filter_value: str | None = None,
    max_files_per_trigger: int = 1000,
    file_format: str = "json",
) -> DataFrame:
    """New files of a folder, JSON or Parquet, to examples, as they land."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format == "json":
        reader = reader.option("mode", "FAILFAST")
    kept = filters.field_equals(reader.format(file_format).load(path), filter_field, filter_value)
    return normalize.normalize(kept, style, config, origin, F.col(key))


def jsonl_stream(
    spark: SparkSession, path: str, config: CorpusConfig, origin: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    """New JSON lines files of a folder, chats and code rows, to examples; chats keep their line.
    Keys, and so example ids, are those of the batch reader."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    landed = rows.parsed_lines(lines)
    return normalize.normalize_jsonl(landed, config, origin, F.col(rows.ROW_KEY))


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of the log lines of a folder, as files land."""
    return logs.parse_log(spark.readStream.text(path))


def line_stream(spark: SparkSession, path: str) -> DataFrame:
    """Log lines of a folder as files land, with what `logs.numbered` needs to number them."""
    return spark.readStream.text(path).select(*logs.landed_line())


def run_available(stream: DataFrame, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append everything that has landed to Parquet files, exactly once, then stop.

    Progress lives in the checkpoint, so the next run starts where this one ended. Give a
    fixed `checkpoint` for that; by default each run gets a new one in the shared folder.
    """
    where = checkpoint or scratch_dir(stream.sparkSession, "stream-checkpoint")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", where)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
