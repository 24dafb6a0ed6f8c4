"""Readers of landed row data: chat rows, JSON lines, external datasets."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import schemas
from corpusflow.config import DatasetConfig
from corpusflow.operators import filters
from corpusflow.operators.modules import ancestors
from corpusflow.sources.commits import Folder
from corpusflow.sources.files import path_exists, qualified

log = logging.getLogger(__name__)

ROW_KEY = "row_key"
DEFAULT_SPLIT = "train"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line. Blank lines are skipped, a malformed line fails the job,
    a missing path gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, schemas.CHAT)


def row_schema(spark: SparkSession, dataset: DatasetConfig) -> T.StructType:
    """Columns of a dataset: those of its format plus the filter field, with the type that
    Parquet files give it; text formats are read as text."""
    base = schemas.ROW_SCHEMAS.get(dataset.format, schemas.ROW_SCHEMAS["code"])
    field = dataset.filter_field
    if not field or field in base.names:
        return base
    kind: T.DataType = T.StringType()
    if dataset.file_format == "parquet":
        landed = spark.read.parquet(dataset.path).schema
        kind = landed[field].dataType if field in landed.names else kind
    return T.StructType([*base.fields, T.StructField(field, kind)])


DATASET = "__dataset"


@dataclass
class Kind:
    """Datasets whose files are read by one scan: same type, format, columns and filter field."""

    type: str
    format: str
    file_format: str
    schema: T.StructType
    field: str | None
    datasets: list[DatasetConfig]


def kinds(spark: SparkSession, datasets: Iterable[DatasetConfig]) -> list[Kind]:
    """Known, readable datasets by kind. Others are reported and skipped.

    A dataset whose folder holds another one's, or has partition folders, is a kind of its own: a
    file then belongs to one dataset of its scan, and the scan has one set of partition columns.
    """
    found: dict[str, Kind] = {}
    for dataset in datasets:
        if dataset.type not in ("jsonl", "table"):
            log.warning("dataset %s: unknown type %s, skipped", dataset.name, dataset.type)
            continue
        dataset = located(spark, dataset)
        if not path_exists(spark, dataset.path):
            log.warning("dataset %s: %s does not exist, skipped", dataset.name, dataset.path)
            continue
        try:
            schema = schemas.JSONL_ROW if dataset.type == "jsonl" else row_schema(spark, dataset)
        except (PySparkException, Py4JJavaError) as unreadable:  # broken or foreign files
            reason = str(unreadable).split("\n")[0]
            log.warning("dataset %s: %s can't be read, skipped: %s", dataset.name, dataset.path, reason)
            continue
        field = dataset.filter_field if dataset.type == "table" else None
        shape = (dataset.type, dataset.format, dataset.file_format, schema.json(), field)
        if dataset.type == "jsonl":
            shape = ("jsonl",)
        alone = has_partitions(spark, dataset.path) or any(
            overlap(spark, dataset.path, other.path) for kind in found.values() for other in kind.datasets
        )
        name = str((shape, dataset.name if alone else ""))
        kind = found.setdefault(name, Kind(dataset.type, dataset.format, dataset.file_format, schema, field, []))
        kind.datasets.append(dataset)
    return list(found.values())


def located(spark: SparkSession, dataset: DatasetConfig) -> DatasetConfig:
    """With the folder of its subset and split, where the dataset was landed in such folders:
    path/subset/split, names as they are or as partitions. Only that folder is read."""
    path = dataset.path.rstrip("/")
    split = dataset.split or (DEFAULT_SPLIT if dataset.type == "table" else None)
    for name, asked in (("subset", dataset.subset), ("split", split)):
        for folder in (asked, f"{name}={asked}") if asked else ():
            if path_exists(spark, f"{path}/{folder}"):
                path = f"{path}/{folder}"
                break
        else:
            if getattr(dataset, name):
                path = f"{path}/{asked}"
    return replace(dataset, path=path)


def has_partitions(spark: SparkSession, path: str) -> bool:
    return any("=" in name for name in Folder(spark, path).names())


def overlap(spark: SparkSession, one: str, other: str) -> bool:
    a, b = (f"{file_prefix(spark, p)}/" for p in (one, other))
    return a.startswith(b) or b.startswith(a)


def file_prefix(spark: SparkSession, path: str) -> str:
    """A path as the metadata of rows spell it, with one slash behind the scheme."""
    shown = spark._jvm.org.apache.hadoop.fs.Path(qualified(spark, path)).toUri().toString()
    return re.sub("^([a-z0-9]+):/+", r"\1:/", shown).rstrip("/")


def dataset_of(spark: SparkSession, datasets: list[DatasetConfig]) -> Column:
    """Name of the dataset that a row's file lies in, or is."""
    if len(datasets) == 1:
        return F.lit(datasets[0].name)
    entries = [F.lit(x) for d in datasets for x in (file_prefix(spark, d.path), d.name)]
    names = F.create_map(*entries)
    file = F.regexp_replace("_metadata.file_path", "^([a-z0-9]+):/+", "$1:/")
    known = F.filter(ancestors(file), lambda a: F.map_contains_key(names, a))
    return F.try_element_at(names, F.try_element_at(known, F.lit(-1)))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Lines (value, …) to rows of a JSON lines dataset with their text and key. Blank lines drop
    out, a malformed line fails the job."""
    more = [c for c in lines.columns if c != "value"]
    parsed = F.from_json("value", schemas.JSONL_ROW, {"mode": "FAILFAST"}).alias("row")
    table = lines.filter(F.col("value").rlike(r"\S")).select(parsed, F.col("value").alias("raw"), *more)
    return table.select("row.*", "raw", *more, F.md5("raw").alias(ROW_KEY))


def read_kind(spark: SparkSession, kind: Kind, filtered: bool = True) -> DataFrame:
    """Rows of all datasets of a kind with their dataset's name and a repeatable `row_key`, if
    `filtered` those that meet their dataset's filter. Columns the files lack read as null.

    Lines of JSON lines datasets also keep their text in `raw`, so that chats can be handed on
    unchanged.
    """
    paths = [d.path for d in kind.datasets]
    name = dataset_of(spark, kind.datasets).alias(DATASET)
    if kind.type == "jsonl":
        return parsed_lines(spark.read.text(paths).select("value", name))
    reader = spark.read.format(kind.file_format).schema(kind.schema)
    if kind.file_format == "json":
        reader = reader.option("mode", "FAILFAST")
    table = reader.load(paths)
    keyed = table.select("*", content_key(table).alias(ROW_KEY), name)
    if not filtered:
        return keyed
    if len(kind.datasets) == 1:
        return filters.field_equals(keyed, kind.field, kind.datasets[0].filter_value)
    return filters.field_equals_by(keyed, kind.field, DATASET, {d.name: d.filter_value for d in kind.datasets})


def canonical(column: Column, kind: T.DataType) -> Column:
    """A value as text from which it can be told apart from any other: texts with their length,
    nulls as '-', arrays and structs as their parts in brackets."""
    if isinstance(kind, T.ArrayType):
        parts = F.transform(column, lambda x: canonical(x, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(parts, ""), F.lit("]"))
    elif isinstance(kind, T.StructType):
        text = F.concat(F.lit("{"), *[canonical(column[f.name], f.dataType) for f in kind.fields], F.lit("}"))
    else:
        value = column.cast("string")
        text = F.concat(F.length(value).cast("string"), F.lit(":"), value)
    return F.when(column.isNull(), F.lit("-")).otherwise(text)


def content_key(df: DataFrame) -> Column:
    """md5 of all columns. It depends on nothing but the row: not on files, their splits or
    their number. Equal rows have equal keys and are interchangeable."""
    return F.md5(F.concat(*[canonical(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]))


def read_dataset(spark: SparkSession, dataset: DatasetConfig) -> DataFrame:
    """Rows of one landed dataset, see `read_kind`, before its filter; a missing path gives no rows."""
    found = kinds(spark, [dataset])
    if found:
        return read_kind(spark, found[0], filtered=False).drop(DATASET)
    base = schemas.JSONL_ROW if dataset.type == "jsonl" else schemas.ROW_SCHEMAS.get(dataset.format, schemas.ROW_SCHEMAS["code"])
    empty = spark.createDataFrame([], base).withColumn(ROW_KEY, F.lit(""))
    return empty.withColumn("raw", F.lit("")) if dataset.type == "jsonl" else empty
