"""Metrics from training log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import text as tx

# Fixed patterns: what the trainer prints.
ITERATION = rf"Iter{tx.WS}+(\d+)"
METRICS = {
    "train_loss": rf"Train loss{tx.WS}+([\d.]+)",
    "it_per_sec": rf"It/sec{tx.WS}+([\d.]+)",
    "val_loss": rf"Val loss{tx.WS}+([\d.]+)",
}


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log lines to typed metrics. Blank lines drop out; others pass through as `message`."""
    line = F.rtrim(F.col(column), F.lit(tx.WHITE_SPACE))
    iteration = F.nullif(F.regexp_extract(line, ITERATION, 1), F.lit("")).try_cast("bigint")
    metrics = [
        F.when(F.col("iteration").isNotNull(), F.regexp_extract("__line", pattern, 1).try_cast("double")).alias(name)
        for name, pattern in METRICS.items()
    ]
    others = [c for c in lines.columns if c != column]
    return (
        lines.select(*others, line.alias("__line"), iteration.alias("iteration"))
        .filter(F.col("__line") != "")
        .select(
            *others, "iteration", *metrics, F.when(F.col("iteration").isNull(), F.col("__line")).alias("message")
        )
    )


#: Chunks whose carries are found together.
FAN = 1000


def progress(metrics: DataFrame, run: str, order: str, chunk: int = 100_000) -> DataFrame:
    """Add `advance`: iteration minus the one before it in the run (0 before the first).

    A long run is cut into chunks of its line order, so one run never lands in one task. What a
    chunk takes over from the ones before comes from a table of one row per chunk: within groups of
    `FAN` chunks, and from group to group. So no window holds all lines or all chunks of a run.
    """
    rows = metrics.filter(F.col("iteration").isNotNull()).withColumn(
        "__chunk", F.floor(F.col(order) / chunk)
    )
    ends = rows.groupBy(run, "__chunk").agg(F.max_by("iteration", order).alias("__end"))
    ends = ends.withColumn("__group", F.floor(F.col("__chunk") / FAN))
    groups = ends.groupBy(run, "__group").agg(F.max_by("__end", "__chunk").alias("__last"))
    before = groups.select(run, "__group", F.lag("__last").over(W.partitionBy(run).orderBy("__group")).alias("__first"))
    within = F.lag("__end").over(W.partitionBy(run, "__group").orderBy("__chunk"))
    carried = ends.withColumn("__within", within).join(before, [run, "__group"]).select(
        run, "__chunk", F.coalesce("__within", "__first").alias("__carry")
    )
    inside = W.partitionBy(run, "__chunk").orderBy(order)
    return (
        rows.withColumn("__before", F.lag("iteration").over(inside))
        .join(carried, [run, "__chunk"])
        .withColumn("advance", F.col("iteration") - F.coalesce("__before", "__carry", F.lit(0)))
        .drop("__chunk", "__before", "__carry")
    )


def landed_line() -> list[Column]:
    """Columns of a line as it is landed: its text, its file, and where its part of that begins."""
    return [
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]


def numbered(landed: DataFrame) -> DataFrame:
    """Landed lines (value, file, block), read from Parquet, with `line`, counted from 1 per file.

    A task lands the lines of a block one after another, so their rows in the landed file tell
    their order. Blocks are counted and their counts summed up; lines are neither sorted nor
    gathered, and a file of any length is spread like its blocks.
    """
    rows = landed.select("value", "file", "block", F.col("_metadata.row_index").alias("__at"))
    blocks = rows.groupBy("file", "block").agg(F.count("*").alias("__n"), F.min("__at").alias("__from"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    placed = blocks.select("file", "block", "__from", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__lines"))
    joined = rows.join(placed, ["file", "block"])
    line = (F.col("__at") - F.col("__from") + F.col("__lines") + 1).alias("line")
    return joined.select("value", "file", line)
