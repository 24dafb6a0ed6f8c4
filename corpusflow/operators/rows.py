"""Row filters on costly columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, condition: Column, *columns: Column | str) -> DataFrame:
    """The columns of the rows that meet the condition.

    Same rows as filter + select. A filter, though, is pushed down by the optimizer, which
    then evaluates the columns it tests a second time; for parsing and rendering expressions
    that doubles the work. Exploding a null array drops the row in place. The array holds a
    marker only, so columns that nothing reads are still pruned.
    """
    kept = F.when(condition, F.array(F.lit(True)))
    return df.select("*", F.explode(kept).alias("__kept")).select(*columns)
