"""Sections of Markdown documents, cut inside each document row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.config import MAX_SECTION_CHARS, MIN_SECTION_CHARS
from corpusflow.functions import text as tx

# Fixed patterns: headings of level 2 and 3, whose gap after the marks may span lines, and
# the marks taken out of titles.
HEADING = rf"(?md)^(#{{2,3}}){tx.WS}+(.+)$"
_TITLE_MARKS = r"[`*\[\]()]"


def clean_title(title: Column) -> Column:
    return tx.strip(F.regexp_replace(tx.strip(title), _TITLE_MARKS, ""))


def heading_level(heading: Column) -> Column:
    return F.when(F.startswith(heading, F.lit("###")), F.lit(3)).otherwise(F.lit(2))


def extract_sections(documents: DataFrame, min_chars: int = MIN_SECTION_CHARS) -> DataFrame:
    """Documents (source, domain, path, content) to section units with their position."""
    headings = F.regexp_extract_all("content", F.lit(HEADING), F.lit(0))
    bodies = F.split("content", HEADING, -1)
    # The text before the first heading belongs to no section.
    zipped = F.arrays_zip(headings.alias("heading"), F.slice(bodies, 2, 1 << 30).alias("body"))
    rows = documents.select(
        "source", "domain", "path", F.posexplode(zipped).alias("position", "s")
    ).select(
        "source", "domain", "path", "position",
        F.col("s")["heading"].alias("heading"),
        tx.strip(F.col("s")["body"]).alias("body"),
    )
    title = F.regexp_replace("heading", rf"^#{{2,3}}{tx.WS}+", "")
    return rows.filter(
        F.col("heading").isNotNull() & (F.length("body") >= min_chars)
    ).select(
        clean_title(title).alias("title"),
        F.substring("body", 1, MAX_SECTION_CHARS).alias("content"),
        "domain",
        F.col("source").alias("source_name"),
        F.col("path").alias("file_path"),
        heading_level(F.col("heading")).alias("level"),
        "position",
    )
