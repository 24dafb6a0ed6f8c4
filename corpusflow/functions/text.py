"""Text helpers that follow Python's rules for white space, words and globs."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and \s count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set inside a regex class, and the same set without the newline.
_WS_TAIL = r"\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = rf"[\t-\r{_WS_TAIL}]"
WS_INLINE = rf"[\t\x0b-\r{_WS_TAIL}]"
NOT_WS = rf"[^\t-\r{_WS_TAIL}]"
# Python's \w: letters, digits of any script, underscore.
WORD = r"[\p{L}\p{N}_]"


def strip(c: Column) -> Column:
    """str.strip(): only the two ends are looked at, so long texts stay cheap."""
    return F.trim(c, F.lit(WHITE_SPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def decode_text(content: Column) -> Column:
    """Bytes to text: bad UTF-8 is replaced and every newline form becomes \\n."""
    return fold_newlines(F.make_valid_utf8(content.cast("string")))


def fold_newlines(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def first_non_empty(*columns: Column) -> Column:
    """First column that is neither null nor '', else ''. Blank text counts as filled."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Directory part, '' for a path without a slash."""
    cut = F.length(path) - F.length(basename(path)) - 1
    return F.substring(path, F.lit(1), F.greatest(cut, F.lit(0)))


def camel_words(name: Column) -> Column:
    """CamelCase to lower-case words."""
    split_low = F.regexp_replace(name, r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.lower(F.regexp_replace(split_low, r"(?<=[A-Z])(?=[A-Z][a-z])", " "))


def comment_lines(text: Column) -> Column:
    """Put a // marker before each line; an empty line becomes a bare marker."""
    marked = F.transform(
        F.split(text, "\n", -1),
        lambda line: F.when(line == "", F.lit("//")).otherwise(F.concat(F.lit("// "), line)),
    )
    return F.array_join(marked, "\n")


def position_of_last(text: Column, char: str) -> Column:
    """1-based position of the last occurrence, 0 if there is none."""
    return F.length(text) - F.length(F.substring_index(text, char, -1))


def before_first(text: Column, char: str) -> Column:
    """Text before the first occurrence of `char` ('' if absent)."""
    return F.substring(text, F.lit(1), F.greatest(F.instr(text, char) - 1, F.lit(0)))


def between_first_and_last(text: Column, opening: str, closing: str) -> Column:
    """Text between the first `opening` and the last `closing`; null if they do not enclose any."""
    first, last = F.instr(text, opening), position_of_last(text, closing)
    return F.when((first > 0) & (last > first), F.substring(text, first + 1, last - first - 1))


def starts_upper(name: Column) -> Column:
    return F.rlike(name, F.lit(r"^\p{Lu}"))


def glob_regex(patterns: Iterable[str], match_root: bool = False) -> str | None:
    """One anchored Java regex for a list of shell globs, None for an empty list.

    `*` crosses slashes, so `**/x` needs a slash before x. With `match_root` a leading
    `**/` also matches at the root.
    """
    alternatives = []
    for pattern in patterns:
        forms = [pattern]
        if match_root and pattern.startswith("**/"):
            forms.append(pattern[3:])
        for form in forms:
            body = fnmatch.translate(form)
            for end in (r"\Z", r"\z"):
                body = body.removesuffix(end)
            alternatives.append(body)
    return rf"^(?:{'|'.join(alternatives)})\z" if alternatives else None
