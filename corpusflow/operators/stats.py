"""Counts per source and in total. All are map-side combined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_stats(units: DataFrame) -> DataFrame:
    def kind(name: str):
        return F.count_if(F.col("kind") == name)

    return units.groupBy(F.col("project_name").alias("source")).agg(
        F.count("*").alias("units"),
        kind("func").alias("funcs"),
        kind("method").alias("methods"),
        kind("type_struct").alias("structs"),
        kind("type_interface").alias("interfaces"),
        F.count_if(F.col("exported")).alias("exported"),
    )


def section_stats(sections: DataFrame) -> DataFrame:
    return sections.groupBy(F.col("source_name").alias("source")).agg(
        F.count("*").alias("sections"),
        F.count_if(F.col("level") == 2).alias("h2"),
        F.count_if(F.col("level") == 3).alias("h3"),
    )


def totals(rows: DataFrame, by: str, count_name: str = "rows") -> DataFrame:
    """Count per value of `by`, plus the grand total under 'total'."""
    return (
        rows.rollup(by)
        .agg(F.count("*").alias(count_name), F.grouping(by).alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.col(by)).alias(by), count_name
        )
    )
