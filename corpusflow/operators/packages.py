"""One overview example per package.

A package may hold any share of the units, so its members are never collected. Units are
first summed up per file, in one pass; a file is a single input row and therefore bounded.
Packages then combine file summaries: counts and the doc are map-side combined, and the
short lists come from a ranked window whose limit Spark applies before the shuffle, so each
task sends at most a handful of rows per package.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.config import (
    MAX_PACKAGE_DOC_CHARS,
    MAX_PACKAGE_FILES,
    MAX_PACKAGE_NAMES,
    MIN_PACKAGE_UNITS,
    CorpusConfig,
)
from corpusflow.functions import chat
from corpusflow.functions import text as tx
from corpusflow.operators.examples import fill

PACKAGE = ["project_name", "module_path", "package_name"]


def file_summary(units: DataFrame) -> DataFrame:
    """Per package and file: counts, the preferred doc, the first public names in line order."""
    is_type = F.startswith("kind", F.lit("type_")) & F.col("exported")
    is_func = F.col("kind").isin("func", "method") & F.col("exported")
    # The doc of a documented init function goes first, then line order.
    is_init = (F.col("kind") == "func") & (F.col("name") == "init")
    rank = F.struct((~is_init).alias("later"), "file_path", "line_number")
    doc = F.when(F.col("doc_comment") != "", F.substring("doc_comment", 1, MAX_PACKAGE_DOC_CHARS))

    def first_names(which: Column) -> Column:
        named = F.array_sort(F.collect_list(F.when(which, F.struct("line_number", "name"))))
        return F.transform(F.slice(named, 1, MAX_PACKAGE_NAMES), lambda e: e["name"])

    return units.groupBy(*PACKAGE, "file_path").agg(
        F.count("*").alias("n_units"),
        F.count_if(is_type).alias("n_types"),
        F.count_if(is_func).alias("n_functions"),
        F.min(F.when(doc.isNotNull(), F.struct(rank.alias("rank"), doc.alias("doc")))).alias("doc"),
        first_names(is_type).alias("types"),
        first_names(is_func).alias("functions"),
    )


def package_summary(units: DataFrame) -> DataFrame:
    """Package keys with member counts, chosen doc, first files and first public names."""
    files = file_summary(units)
    counts = (
        files.groupBy(*PACKAGE)
        .agg(
            F.sum("n_units").alias("n_units"),
            F.sum("n_types").alias("n_types"),
            F.sum("n_functions").alias("n_functions"),
            F.min("doc")["doc"].alias("doc"),
        )
        .filter(F.col("n_units") >= MIN_PACKAGE_UNITS)
    )

    def entry(which: str, names: Column) -> Column:
        return F.struct(F.lit(which).alias("list"), names.alias("names"))

    shown = F.array(
        entry("files", F.array(tx.basename(F.col("file_path")))),
        entry("types", F.col("types")),
        entry("functions", F.col("functions")),
    )
    listed = files.select(
        *PACKAGE, "file_path", F.inline(F.filter(shown, lambda e: F.size(e["names"]) > 0))
    )
    # Each listed file has a name, so the first files hold all names that can be shown.
    ranked = W.partitionBy(*PACKAGE, "list").orderBy("file_path")
    first = listed.withColumn("rank", F.row_number().over(ranked)).filter(
        F.col("rank") <= max(MAX_PACKAGE_FILES, MAX_PACKAGE_NAMES)
    )

    def joined(which: str, limit: int) -> Column:
        ordered = F.array_sort(
            F.collect_list(F.when(F.col("list") == which, F.struct("file_path", "names")))
        )
        names = F.flatten(F.transform(ordered, lambda e: e["names"]))
        return F.array_join(F.slice(names, 1, limit), ", ").alias(which)

    lists = first.groupBy(*PACKAGE).agg(
        joined("files", MAX_PACKAGE_FILES),
        joined("types", MAX_PACKAGE_NAMES),
        joined("functions", MAX_PACKAGE_NAMES),
    )
    return counts.join(lists, PACKAGE)


def package_examples(units: DataFrame, config: CorpusConfig) -> DataFrame:
    w = config.wording
    summary = package_summary(units)
    keys = {"project": F.col("project_name"), "module": F.col("module_path"), "package": F.col("package_name")}

    def line(template: str, count: str, names: str):
        return F.when(
            F.col(count) > 0, fill(template, count=F.col(count).cast("string"), names=F.col(names))
        )

    answer = F.concat_ws(
        "\n",
        F.coalesce("doc", fill(w.overview_fallback, **keys)),
        F.concat(F.lit("\n"), fill(w.files, names=F.col("files"))),
        line(w.types, "n_types", "types"),
        line(w.functions, "n_functions", "functions"),
    )
    return summary.select(
        F.concat_ws("|", F.lit("package"), *PACKAGE).alias("example_id"),
        F.lit("code").alias("origin"),
        F.lit("package_overview").alias("example_type"),
        chat.triple(config.system_prompt, fill(w.overview, **keys), answer).alias("conversations"),
    )
