"""Text helpers against Python's own behaviour."""

import fnmatch
import os
import random
import re

from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import filters, sections


def apply(spark, values, expression):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    return [r.out for r in rows.select(expression(F.col("v")).alias("out")).collect()]


def random_text(rng, alphabet, size):
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(size)))


def test_strip_matches_python(spark):
    rng = random.Random(1)
    alphabet = ["a", "\u00e9", "\U0001d4b3", "\u200b", *tx.WHITE_SPACE]
    values = [random_text(rng, alphabet, 8) for _ in range(500)]
    assert apply(spark, values, tx.strip) == [v.strip() for v in values]
    assert apply(spark, values, tx.lstrip) == [v.lstrip() for v in values]
    assert apply(spark, values, tx.is_blank) == [not v.strip() for v in values]


def test_white_space_class_is_pythons():
    expected = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(tx.WHITE_SPACE) == expected
    assert {chr(i) for i in range(0x110000) if re.fullmatch(tx.WS, chr(i))} == expected


def test_globs_match_fnmatch(spark):
    rng = random.Random(2)
    patterns = ["**/vendor/**", "**/*_generated.go", "**/zz_generated*", "a?c/*.go", "[ab]/[!c]*", "x.go"]
    parts = ["vendor", "a", "abc", "zz_generated.x", "x_generated.go", "x.go", "c1", "b"]
    paths = ["/".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(400)]
    regex = tx.glob_regex(patterns)
    got = apply(spark, paths, lambda p: F.rlike(p, F.lit(regex)))
    assert got == [any(fnmatch.fnmatch(p, g) for g in patterns) for p in paths]
    assert True in got and False in got
    assert tx.glob_regex([]) is None


def test_camel_words(spark):
    expected = {
        "HTTPServer": "http server", "parseURLFast": "parse url fast", "a2B": "a2 b", "ABC": "abc",
        "getHTTP2Conn": "get http2 conn", "snake_Case": "snake_case", "X": "x", "": "", "aBcD": "a bc d",
        "AbCd": "ab cd", "JSONToXMLMap": "json to xml map",
    }
    assert apply(spark, list(expected), tx.camel_words) == list(expected.values())


def test_paths(spark):
    paths = ["a", "a/b", "a/b/c.go", "/x", ""]
    assert apply(spark, paths, tx.basename) == [os.path.basename(p) for p in paths]
    assert apply(spark, paths, tx.dirname) == ["", "a", "a/b", "", ""]


def test_brace_slices(spark):
    rng = random.Random(6)
    values = [random_text(rng, "{}a\U0001d4b3\n", 9) for _ in range(300)]

    def python(v):
        first, last = v.find("{"), v.rfind("}")
        return v[first + 1 : last] if first != -1 and last > first else None

    assert apply(spark, values, lambda v: tx.between_first_and_last(v, "{", "}")) == list(map(python, values))
    assert apply(spark, values, lambda v: tx.before_first(v, "{")) == [
        v[: v.find("{")] if "{" in v else "" for v in values
    ]


def test_tolerant_decoding(spark):
    raw = [b"ok\r\nx\ry\n", b"bad \xff\xfe end", "\u00e9\U0001d4b3".encode(), b"cut \xe2\x82", b""]
    rows = spark.createDataFrame([(bytearray(r),) for r in raw], "v binary")
    got = [r.out for r in rows.select(tx.decode_text(F.col("v")).alias("out")).collect()]
    assert got == [
        r.decode("utf-8", errors="replace").replace("\r\n", "\n").replace("\r", "\n") for r in raw
    ]


def test_path_rules(spark):
    paths = [
        "README.md", "docs/A.MD", "docs/ChangeLog.md", ".github/x.md", "a/node_modules/b.md",
        "docs/license-notes.md", "vendor.md", "docs/authors/x.md", "docs/x.markdown",
    ]
    kept = [p for p, ok in zip(paths, apply(spark, paths, filters.is_markdown_path)) if ok]
    assert kept == ["README.md", "docs/A.MD", "vendor.md", "docs/authors/x.md"]


def test_field_filter(spark):
    rows = spark.createDataFrame([("go", 1), ("py", 2), (None, 3)], "lang string, n int")

    def kept(*args):
        return sorted(r.n for r in filters.field_equals(rows, *args).collect())

    assert kept("lang", "go") == [1] and kept("lang", None) == [3]
    assert kept("absent", "go") == [] and kept("absent", None) == [1, 2, 3]
    assert kept(None, "go") == [1, 2, 3]


def _heading_at(text, start):
    """(level, title, end) of a heading that begins at a line start, by hand."""
    level = 0
    while text[start + level : start + level + 1] == "#":
        level += 1
    gap = at = start + level
    while at < len(text) and text[at].isspace():
        at += 1
    if level not in (2, 3) or at == gap:
        return None
    if at == len(text):
        # Only white space is left: its last character that is no newline is the title.
        rest = [p for p in range(gap + 1, at) if text[p] != "\n"]
        if not rest:
            return None
        at = rest[-1]
    end = text.find("\n", at)
    end = len(text) if end < 0 else end
    return level, text[at:end], end


def _python_sections(text):
    found, at = [], 0
    while at <= len(text):
        head = _heading_at(text, at) if at == 0 or text[at - 1] == "\n" else None
        if head:
            found.append((at, *head))
        at = head[2] if head and head[2] > at else at + 1
    for i, (_, level, title, end) in enumerate(found):
        stop = found[i + 1][0] if i + 1 < len(found) else len(text)
        clean = "".join(c for c in title.strip() if c not in "`*[]()").strip()
        yield i, level, clean, text[end:stop].strip()


def test_sections_match_a_python_splitter(spark):
    rng = random.Random(7)
    pieces = ["# ", "## ", "### ", "#### ", "##", "text", "`b*[c](d)", "\n", "\n", "\n", "\n\n", " ", "\x85", "\u3000", "```\n", "\u00e9"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(400)]
    rows = spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(texts)], "path string, content string"
    ).select(F.lit("s").alias("source"), F.lit("d").alias("domain"), "path", "content")
    got = sections.extract_sections(rows, min_chars=0).collect()
    found = sorted((r.file_path, r.position, r.level, r.title, r.content) for r in got)
    expected = sorted((str(i), *s) for i, t in enumerate(texts) for s in _python_sections(t))
    assert found == expected
    assert len(found) > 300


def test_section_limits(spark):
    bodies = ["x" * n for n in (99, 100, 6000, 6001)]
    content = "# Top\nintro\n" + "".join(f"## [H{i}](u)\n{b}\n\n" for i, b in enumerate(bodies))
    rows = spark.createDataFrame([("s", "d", "f.md", content)], "source string, domain string, path string, content string")
    got = {r.title: len(r.content) for r in sections.extract_sections(rows).collect()}
    assert got == {"H1u": 100, "H2u": 6000, "H3u": 6000}
