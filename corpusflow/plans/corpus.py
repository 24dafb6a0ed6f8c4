"""The corpus job and the statistics job."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import schemas
from corpusflow.config import CorpusConfig, DatasetConfig
from corpusflow.functions import text as tx
from corpusflow.functions.hashing import keep_share
from corpusflow.operators import (
    code_units,
    examples,
    filters,
    modules,
    normalize,
    packages,
    sampling,
    sections,
    stats,
)
from corpusflow.operators.accounts import Accounts
from corpusflow.sources import catalog, commits, files, rows, sinks, walk
from corpusflow.sources.scratch import scratch_scope, stage

log = logging.getLogger(__name__)

#: Codec of staged units and examples.
STAGED_TEXTS = "zstd"
_SECTIONS = T.StructType([*schemas.SECTION.fields, T.StructField("position", T.IntegerType())])


def units_from_files(
    code_files: DataFrame,
    manifests: DataFrame,
    config: CorpusConfig,
    accounts: Accounts | None = None,
    paths: DataFrame | None = None,
) -> DataFrame:
    """Code files (source, path, content) and manifests to units.

    Few manifests travel as a constant and name the files' modules before they are parsed. With
    more of them the units get their modules in the end, by a join: file contents never move.
    `paths` (source, path) of the files are given where those of `code_files` cost a read of contents.
    """
    chosen = code_units.select_paths(code_files, config)
    lookup = modules.Lookup(manifests)
    if lookup.fits_map():
        placed = lookup.by_map(chosen)
        return code_units.extract_units(code_units.select_contents(placed, config), accounts)
    unplaced = chosen.withColumn("module_path", F.lit(""))
    units = code_units.extract_units(code_units.select_contents(unplaced, config), accounts)
    named = chosen if paths is None else code_units.select_paths(paths, config)
    placed = lookup.by_join(units.drop("module_path"), named, "file_path", "project_name")
    return placed.select(*units.columns)


def landed_table(spark: SparkSession, path: str, sound: bool = False) -> DataFrame:
    """A table of files (source, path, content), contents as text or bytes, decoded like files."""
    landed = spark.read.parquet(path)
    decoded = tx.decode_text(F.col("content")).alias("content")
    checked = [F.is_valid_utf8(F.col("content").cast("string")).alias("sound")] if sound else []
    return landed.select("source", "path", decoded, *checked)


def landed_sources(
    spark: SparkSession, config: CorpusConfig, accounts: Accounts | None = None
) -> tuple[DataFrame, DataFrame]:
    """Units and sections from one table of files: one plan, whatever the number of sources."""
    listed = catalog.source_table(spark, config.sources)
    landed = landed_table(spark, config.landed_files, sound=accounts is not None)
    for row in catalog.unknown_sources(landed.select("source"), listed).take(20):
        log.warning("source %s: %s files, not in the settings, skipped", row["source"], row["rows"])
    for source in config.sources:
        if source.type not in ("go_code", "spec"):
            log.warning("source %s: unknown type %s, skipped", source.name, source.type)
    placed = catalog.attach_source(landed, listed)
    code = placed.filter("type = 'go_code'").drop("type", "domain")
    manifests = modules.read_manifests(code)
    spec = placed.filter((F.col("type") == "spec") & filters.is_markdown_path(F.col("path")))
    units = units_from_files(_code_only(code, accounts, listed=False), manifests, config, accounts)
    return units, sections.extract_sections(spec.select("source", "path", "content", "domain"))


def _code_only(files_in: DataFrame, accounts: Accounts | None, listed: bool) -> DataFrame:
    code = files_in.filter(tx.basename(F.col("path")).rlike(tx.glob_regex([files.CODE])))
    if accounts:
        # Files that were listed and don't come are those that couldn't be read.
        missing = {"unreadable_files": -F.count("*")} if listed else {}
        code = accounts.watch(
            code, code_files=F.count("*"), undecodable_files=F.count_if(~F.col("sound")), **missing
        )
    return code.select("source", "path", "content")


def _add_listed(accounts: Accounts, listed: DataFrame, kind: str, most_bytes: int) -> None:
    found = files.listed_counts(listed, files.CODE if kind == "go_code" else files.MARKDOWN, most_bytes)
    accounts.add("oversized_files", found["oversized"])
    accounts.add("unreadable_folders", found["unreadable"])
    if kind == "go_code":
        accounts.add("unreadable_files", found["readable"])


def read_sources(
    spark: SparkSession, config: CorpusConfig, accounts: Accounts | None = None
) -> tuple[DataFrame, DataFrame]:
    """Units and sections of all configured sources.

    A missing path or an unknown type is reported and skipped. `accounts` gets counts of the files
    that were left out or looked odd, once the units have been computed.
    """
    if config.landed_files:
        return landed_sources(spark, config, accounts)
    code, manifests, documents, paths = [], [], [], []
    for source in config.sources:
        if not files.path_exists(spark, source.path):
            log.warning("source %s: %s does not exist, skipped", source.name, source.path)
            continue
        if source.type not in ("go_code", "spec"):
            log.warning("source %s: unknown type %s, skipped", source.name, source.type)
            continue
        base = files.qualified(spark, source.path)
        options = {"most_bytes": config.max_file_bytes}
        if walk.can_open(base):
            options["listed"] = walk.walk(spark, base)
            if accounts:
                _add_listed(accounts, options["listed"], source.type, config.max_file_bytes)
        if source.type == "go_code":
            code.append(files.scan_code(spark, source.path, source.name, sound=accounts is not None, **options))
            manifests.append(files.scan_manifests(spark, source.path, source.name, **options))
            if "listed" in options:
                named = files.listed_paths(options["listed"], source.name, files.CODE, config.max_file_bytes)
            else:
                named = code[-1].select("source", "path")
            paths.append(named)
        else:
            tree = files.scan_markdown(spark, source.path, source.name, **options)
            documents.append(tree.withColumn("domain", F.lit(source.domain or source.name)))
    units = (
        units_from_files(
            _code_only(reduce(DataFrame.unionByName, code), accounts, listed="unreadable_files" in accounts.known)
            if accounts
            else reduce(DataFrame.unionByName, code),
            reduce(DataFrame.unionByName, manifests),
            config,
            accounts,
            reduce(DataFrame.unionByName, paths),
        )
        if code
        else spark.createDataFrame([], schemas.UNIT)
    )
    found = (
        sections.extract_sections(reduce(DataFrame.unionByName, documents))
        if documents
        else spark.createDataFrame([], _SECTIONS)
    )
    return units, found


def code_overviews(units: DataFrame, config: CorpusConfig) -> DataFrame:
    overviews = packages.package_examples(units, config)
    if config.sample_all:
        weight = config.weight("package_overview")
        overviews = overviews.filter(
            keep_share(F.col("example_id"), config.seed, "package_overview", weight)
        )
    return overviews


def code_examples(units: DataFrame, config: CorpusConfig) -> DataFrame:
    made = examples.unit_examples(units, config)
    if config.weight("package_overview") <= 0:
        return made
    return made.unionByName(code_overviews(units, config))


def dataset_examples(
    spark: SparkSession, dataset: DatasetConfig, config: CorpusConfig
) -> DataFrame | None:
    """Examples of one landed dataset: filter, normalise, cap. None for an unknown type, and for a
    missing or unreadable path."""
    made = all_dataset_examples(spark, (dataset,), config)
    return made[0] if made else None


def all_dataset_examples(
    spark: SparkSession, datasets: tuple[DatasetConfig, ...], config: CorpusConfig
) -> list[DataFrame]:
    """Examples of landed datasets, one table per kind of files and not per dataset.

    Datasets whose rows look alike are one scan. The row's dataset comes from its file's path; its
    filter value and cap come from maps, and the caps of all are found by one histogram.
    """
    return [_kind_examples(spark, kind, config) for kind in rows.kinds(spark, datasets)]


def _kind_examples(spark: SparkSession, kind: rows.Kind, config: CorpusConfig) -> DataFrame:
    table = rows.read_kind(spark, kind)
    origin, key = F.col(rows.DATASET), F.col(rows.ROW_KEY)

    def made_from(landed: DataFrame) -> DataFrame:
        if kind.type == "jsonl":
            return normalize.normalize_jsonl(landed, config, origin, key)
        return normalize.normalize(landed, kind.format, config, origin, key)

    caps = {d.name: d.max_samples for d in kind.datasets if d.max_samples}
    if not caps:
        return made_from(table)
    # Only ids are staged for the caps, and only kept rows are converted in the end.
    name = normalize.example_id(origin, key)
    if len(kind.datasets) == 1:
        ids = stage(made_from(table).select("example_id"), "ids")
        return made_from(sampling.cap_by(table, name, ids, *caps.values(), config.seed))
    capped = table.filter(origin.isin(list(caps))) if len(caps) < len(kind.datasets) else table
    ids = stage(made_from(capped).select(F.col("origin").alias(rows.DATASET), "example_id"), "ids")
    return made_from(sampling.cap_groups(table, rows.DATASET, name, ids, caps, config.seed))


def build_examples(
    units: DataFrame, found_sections: DataFrame, config: CorpusConfig
) -> DataFrame:
    """All examples of the configured sources and datasets; duplicates stay."""
    spark = units.sparkSession
    parts = [code_examples(units, config)]
    if config.weight("spec_explanation") > 0:
        parts.append(examples.section_examples(found_sections, config))
    every = [*parts, *all_dataset_examples(spark, config.datasets, config)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), every)


def example_counts(units: DataFrame, found_sections: DataFrame, config: CorpusConfig) -> DataFrame:
    """(origin, example_type) of the examples `build_examples` makes of units and sections, for
    counting: no text of an example is made, and units are staged by their lengths."""
    counted = stage(examples.counted_units(units), "counted-units")
    parts = [examples.unit_example_types(counted, config)]
    if config.weight("package_overview") > 0:
        parts.append(code_overviews(counted, config).select("origin", "example_type"))
    if config.weight("spec_explanation") > 0:
        parts.append(examples.section_examples(found_sections, config).select("origin", "example_type"))
    return reduce(DataFrame.unionByName, parts)


def run_corpus(
    spark: SparkSession,
    config: CorpusConfig,
    out: str | None = None,
    ordered: bool = True,
    accounts: Accounts | None = None,
) -> dict[str, dict[str, int]]:
    """Extract, generate, split and write train/val examples and units.

    Returns the rows written per part and the examples per origin with their total. `accounts` has
    counts of files that were left out or looked odd; those that aren't 0 are logged too.

    Units and examples are staged once: the split needs two narrow passes over the example
    ids, and a lost executor then costs a re-read, not a re-extraction. Staged folders are
    removed in the end. `ordered=False` leaves the seeded order of the files out, and with it
    the sort of the whole corpus. Parts replace those of an earlier run together; a run that
    fails leaves them as they were.
    """
    out, accounts = out or config.output, accounts or Accounts()
    with scratch_scope(spark):
        units, found = read_sources(spark, config, accounts)
        units = stage(units, "units", STAGED_TEXTS)
        staged = stage(build_examples(units, found, config), "examples", STAGED_TEXTS)
        split = sampling.holdout(staged, "example_id", config.seed)
        placed = sampling.shuffled(split, "example_id", config.seed, "split") if ordered else split
        written = Observation("written")
        observed = placed.observe(
            written,
            F.count_if(F.col("split") == "train").alias("train"),
            F.count_if(F.col("split") == "val").alias("val"),
        )
        counted = Observation("units")
        with commits.replacing(spark, out) as fresh:
            sinks.write_split(observed, f"{fresh}/examples", config.output_compression)
            every = units.observe(counted, F.count("*").alias("units"))
            sinks.write_units(every, f"{fresh}/units", config.output_compression)
        # One row per configured origin.
        origins = stats.totals(staged, "origin", "examples").collect()
    for name, number in accounts.totals().items():
        if number and name != "code_files":
            log.warning("%s: %s", name.replace("_", " "), number)
    return {
        "written": {**written.get, **counted.get},
        "examples": {row["origin"]: row["examples"] for row in origins},
    }


def run_training_views(
    spark: SparkSession, corpus: str, out: str, compression: str | None = None
) -> dict[str, int]:
    """Re-shape written train/val rows for training: role/content rows and rendered text.

    Returns the row count of each part. Both views replace those of an earlier run. They are written
    plain or with a `compression`, whatever that of the corpus.
    """
    commits.settle(spark, corpus)
    parts = [
        rows.read_chats(spark, f"{corpus}/examples/split={name}").withColumn("split", F.lit(name))
        for name in ("train", "val")
    ]
    written = Observation("converted")
    both = parts[0].unionByName(parts[1]).observe(
        written,
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
    )
    with commits.replacing(spark, out) as fresh:
        sinks.write_messages(both, f"{fresh}/messages", compression)
        sinks.write_text(parts[0].unionByName(parts[1]), f"{fresh}/text", compression)
    return dict(written.get)


def run_stats(
    spark: SparkSession, config: CorpusConfig, accounts: Accounts | None = None
) -> tuple[DataFrame, DataFrame]:
    """Unit and section counts per source; generates and writes nothing. `accounts` has its counts
    of files once the units have been counted."""
    units, found = read_sources(spark, config, accounts)
    return stats.code_stats(units), stats.section_stats(found)
