"""Module path of each file: the nearest directory above it that has a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.sources.scratch import stage

MANIFEST = "go.mod"
#: Up to so many manifests travel as a constant (about 2 MB).
MOST_MAPPED = 20_000
MODULE_LINE = rf"(?m)^module{tx.WS}+({tx.NOT_WS}+)"


def read_manifests(files: DataFrame) -> DataFrame:
    """Files (source, path, content) to (source, dir, module); files without a name drop out."""
    return (
        files.filter(tx.basename(F.col("path")) == MANIFEST)
        .select(
            "source",
            tx.dirname(F.col("path")).alias("dir"),
            F.regexp_extract("content", MODULE_LINE, 1).alias("module"),
        )
        .filter(F.col("module") != "")
    )


def ancestors(directory: Column) -> Column:
    """The directory itself and every directory above it, '' being the root."""
    parts = F.split(directory, "/", -1)
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
    return F.array_distinct(F.concat(F.array(F.lit("")), above))


def directory_modules(directories: DataFrame, manifests: DataFrame) -> DataFrame:
    """Distinct (source, dir) to (source, dir, module_path), as an equi-join on ancestors.

    No range join and no pairs: a directory gives one row per level, and the manifest side
    is unique per key. Spark broadcasts the manifests when they are small.
    """
    levels = directories.select("source", "dir", F.explode(ancestors(F.col("dir"))).alias("above"))
    found = levels.join(
        manifests.select("source", F.col("dir").alias("above"), "module"), ["source", "above"]
    )
    nearest = found.groupBy("source", "dir").agg(
        F.max_by(F.struct("above", "module"), F.length("above")).alias("hit")
    )
    path = _below(F.col("hit.above"), F.col("dir"), F.col("hit.module"))
    return nearest.select("source", "dir", path.alias("module_path"))


def _below(above: Column, here: Column, module: Column) -> Column:
    """Module path of a directory from the nearest one with a manifest; null without one."""
    rest = F.when(above == "", here).otherwise(F.substring(here, F.length(above) + 2, F.length(here)))
    joined = F.when(above == here, module).otherwise(F.concat_ws("/", module, rest))
    return F.when(above.isNotNull(), joined)


def attach_modules(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Add module_path to files (source, path, …); without a manifest above, the directory.

    Manifests are few next to directories and files. They are staged and counted; up to
    `MOST_MAPPED` they become one map per source, which every task gets as a constant, and a
    file looks its ancestors up inside its row: nothing is shuffled. With more of them the
    lookup runs over distinct directories as an equi-join, and its result is joined to the rows;
    rows with long contents should then get it later, see `Lookup`.
    """
    lookup = Lookup(manifests)
    return lookup.by_map(files) if lookup.fits_map() else lookup.by_join(files, files)


class Lookup:
    """Module paths from manifests (source, dir, module), which are staged once."""

    def __init__(self, manifests: DataFrame):
        named = manifests.groupBy("source", "dir").agg(F.max("module").alias("module"))
        self.manifests = stage(named, "manifests")

    def fits_map(self) -> bool:
        return self.manifests.count() <= MOST_MAPPED

    def by_map(self, files: DataFrame, path: str = "path", source: str = "source") -> DataFrame:
        """Files with their module_path, looked up inside the row."""
        placed = files.withColumn("__dir", tx.dirname(F.col(path)))
        return _named(_mapped(placed, self.manifests, source))

    def by_join(self, rows: DataFrame, files: DataFrame, path: str = "path", source: str = "source") -> DataFrame:
        """Rows that name a file, with its module_path. Of the files (source, path, …) nothing but
        distinct directories is looked up, and of the rows whatever columns they have is joined,
        so this is for rows without file contents."""
        directories = files.select("source", tx.dirname(F.col("path")).alias("dir")).distinct()
        found = stage(directory_modules(directories, self.manifests), "modules")
        placed = rows.withColumn("__dir", tx.dirname(F.col(path)))
        named = found.select(F.col("source").alias("__source"), F.col("dir").alias("__at"), "module_path")
        joined = placed.join(named, (F.col(source) == F.col("__source")) & (F.col("__dir") == F.col("__at")), "left")
        return _named(joined.drop("__source", "__at"))


def _named(placed: DataFrame) -> DataFrame:
    own = F.when(F.col("__dir") == "", F.lit(".")).otherwise(F.col("__dir"))
    return placed.withColumn("module_path", F.coalesce("module_path", own)).drop("__dir")


def _mapped(placed: DataFrame, manifests: DataFrame, source: str) -> DataFrame:
    per_source = manifests.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("dir", "module"))).alias("modules")
    )
    every = per_source.agg(F.map_from_entries(F.collect_list(F.struct("source", "modules")))).scalar()
    looked = placed.withColumn("__modules", F.try_element_at(every, F.col(source)))
    known = F.filter(ancestors(F.col("__dir")), lambda a: F.map_contains_key(F.col("__modules"), a))
    looked = looked.withColumn("__above", F.try_element_at(known, F.lit(-1)))
    module = F.try_element_at(F.col("__modules"), F.col("__above"))
    return looked.withColumn("module_path", _below(F.col("__above"), F.col("__dir"), module)).drop("__modules", "__above")
