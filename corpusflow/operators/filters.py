"""Row filters on paths, file contents and fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as tx

# Directories, file names and phrases that exclude a file.
CODE_SKIP_DIRS = (".git", "vendor", "node_modules", ".idea", "hack")
MARKDOWN_SKIP_DIRS = (".git", "vendor", "node_modules", ".github")
MARKDOWN_SKIP_NAMES = ("changelog", "contributing", "license", "codeowners", "authors")
GENERATED_PHRASES = ("code generated", "do not edit", "auto-generated")
GENERATED_HEAD_LINES = 6
CODE_SUFFIX = ".go"
TEST_SUFFIX = "_test.go"
MARKDOWN_SUFFIX = ".md"


def _quote(word: str) -> str:
    return word.replace(".", r"\.")


def in_directory(path: Column, names: Iterable[str]) -> Column:
    """True if any directory of the relative path has one of the names."""
    return F.rlike(path, F.lit(rf"(?:^|/)(?:{'|'.join(map(_quote, names))})/"))


def is_code_path(
    path: Column,
    include_tests: bool = True,
    skip_patterns: Iterable[str] = (),
    patterns_at_root: bool = False,
) -> Column:
    keep = F.endswith(path, F.lit(CODE_SUFFIX)) & ~in_directory(path, CODE_SKIP_DIRS)
    if not include_tests:
        keep = keep & ~F.endswith(path, F.lit(TEST_SUFFIX))
    denied = tx.glob_regex(skip_patterns, patterns_at_root)
    return keep if denied is None else keep & ~F.rlike(path, F.lit(denied))


def is_markdown_path(path: Column) -> Column:
    name = F.lower(tx.basename(path))
    return (
        F.endswith(name, F.lit(MARKDOWN_SUFFIX))
        & ~F.rlike(name, F.lit("|".join(MARKDOWN_SKIP_NAMES)))
        & ~in_directory(path, MARKDOWN_SKIP_DIRS)
    )


def is_generated(content: Column) -> Column:
    """A generator marker, in any case, within the first lines."""
    head = F.lower(F.substring_index(content, "\n", GENERATED_HEAD_LINES))
    return F.rlike(head, F.lit("|".join(GENERATED_PHRASES)))


def field_equals(df: DataFrame, field: str | None, value: object) -> DataFrame:
    """Optional row filter; a missing field never equals a set value. The value takes the
    field's type; one that has no form in that type equals nothing."""
    if not field:
        return df
    actual = F.col(field) if field in df.columns else F.lit(None).cast("string")
    if value is None:
        return df.filter(actual.isNull())
    kind = df.schema[field].dataType.simpleString() if field in df.columns else "string"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return df.filter(actual == F.lit(text).try_cast(kind))


def field_equals_by(df: DataFrame, field: str | None, by: str, values: dict[str, object]) -> DataFrame:
    """`field_equals` with a value for each group, all groups having the field."""
    if not field:
        return df
    actual, kind = F.col(field), df.schema[field].dataType.simpleString()
    texts = {g: str(v).lower() if isinstance(v, bool) else str(v) for g, v in values.items() if v is not None}
    entries = [F.lit(x) for pair in texts.items() for x in pair]
    asked = F.try_element_at(F.create_map(*entries), F.col(by)) if entries else F.lit(None).cast("string")
    return df.filter(F.when(asked.isNull(), actual.isNull()).otherwise(actual == asked.try_cast(kind)))


def size_between(code: Column, low: int, high: int) -> Column:
    return F.length(code).between(low, high)
