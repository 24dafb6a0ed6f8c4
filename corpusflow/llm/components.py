"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusflow.sources.scratch import stage


def relabelled(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """Replace `column` by its new name where `names` (node, root) has one."""
    other = names.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = df.join(other, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def staged(df: DataFrame, label: str, condition: Column | None = None) -> tuple[DataFrame, int]:
    """The table written, and how many of its rows (that meet the condition) there are."""
    seen = Observation(label)
    counted = F.count("*") if condition is None else F.count_if(condition)
    table = stage(df.observe(seen, counted.alias("rows")), label)
    return table, seen.get["rows"]


def ordered(links: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node that isn't the smallest of its component; links: (a, b) bigint.

    Each pass points every node at its smallest neighbour, shortens the chains by jumping, and
    writes the links between the roots that remain. Nothing is gathered: a pass is made of
    aggregations and joins, and a component of any size takes logarithmically many.
    """
    names = None
    links, left = staged(ordered(links), "links")
    while left:
        found = stage(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "roots")
        changed = 1
        while changed:
            jump = relabelled(found.withColumn("was", F.col("root")), "root", found)
            found, changed = staged(jump, "roots", F.col("root") != F.col("was"))
            found = found.select("node", "root")
        names = found if names is None else stage(relabelled(names, "root", found).unionByName(found), "names")
        links, left = staged(ordered(relabelled(relabelled(links, "a", found), "b", found)), "links")
    if names is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return names
