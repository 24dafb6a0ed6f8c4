"""The source catalog as a table, and its join to rows that name a source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.config import SourceConfig

def source_table(spark: SparkSession, sources: Iterable[SourceConfig]) -> DataFrame:
    """One row per configured source; the domain defaults to the name."""
    entries = [
        F.struct(
            F.lit(s.name).alias("source"),
            F.lit(s.type).alias("type"),
            F.lit(s.domain or s.name).alias("domain"),
        )
        for s in sources
    ]
    if not entries:
        return spark.createDataFrame([], "source string, type string, domain string")
    return spark.range(1).select(F.inline(F.array(*entries)))


def unknown_sources(rows: DataFrame, catalog: DataFrame, column: str = "source") -> DataFrame:
    """Rows per source that the catalog doesn't list, those `attach_source` leaves out."""
    named = F.broadcast(catalog.select(F.col("source").alias(column)))
    return rows.join(named, column, "left_anti").groupBy(column).agg(F.count("*").alias("rows"))


def attach_source(rows: DataFrame, catalog: DataFrame, column: str = "source") -> DataFrame:
    """Add type and domain of the source; rows of unknown sources drop out.

    The catalog comes from the settings file, one row per entry, so broadcasting it is safe.
    """
    named = catalog.withColumnRenamed("source", column)
    return rows.join(F.broadcast(named), column)
