"""Top-level declarations of source files.

A file is one row, and all work on it happens inside that row with array expressions:
no shuffle, no window, and a hot source costs no more than its files.

1. Literals and comments are blanked at equal length, so braces inside them are gone
   while every offset stays valid.
2. Each line gets a class (blank, comment, declaration start, other) and a nesting change
   over all three bracket kinds.
3. One pass over the lines finds the declarations: a start at depth 0 up to the first line
   that ends at depth 0, with the start of the comment block above it. Where all brackets of a
   file pair up by kind, a counter is the depth. Other files are scanned with a stack of open
   kinds: a closer closes the nearest opener of its kind, one without an opener does nothing,
   and a declaration with the least indent of the file starts anew with an empty stack. So a
   stray bracket costs one declaration at most, and not the rest of the file.
4. Only the cut-out declarations leave the row, as an exploded array of small structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.config import CorpusConfig
from corpusflow.functions import text as tx
from corpusflow.operators import filters
from corpusflow.operators.accounts import Accounts
from corpusflow.operators.rows import keep_where

# Splits any text into comments, string, raw string and rune literals, and the rest.
# Joined back together the tokens give the input. Possessive, so no deep recursion.
LEXER = (
    r"(?s)//[^\n]*+"
    r"|/\*.*?\*/"
    r'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
    r"|`[^`]*+`"
    r"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
    r"""|[^/"`']++"""
    r"|."
)

# Line classes.
OTHER, BLANK, COMMENT, DECLARATION, RESTART = 0, 1, 2, 3, 4
# Lines per part of the scan; the list of spans grows once per part.
SCAN_LINES = 256
# Stands for the start of a function or of a type that is not a group.
MARK = "\x01"
DECLARATION_START = rf"(?md)^{tx.WS_INLINE}*(?:func |type (?!\())"

# Text before the body brace of a function; braces of type literals belong to it.
# Deeper nesting than this expression covers leaves an uneven head; then brackets are counted.
_TYPE_BRACES = r"(?<=\b(?:struct|interface)[ \t]{0,8})\{(?:[^{}]++|\{(?:[^{}]++|\{[^{}]*+\})*+\})*+\}"
FUNC_HEAD = rf"^((?:[^{{}}]++|{_TYPE_BRACES})*+)\{{"
_TYPE_PARAMS = rf"(?:\[{tx.WS}*{tx.WORD}+[\s,](?:[^\[\]]++|\[[^\[\]]*+\])*+\])?"
TYPE_HEAD = rf"^({tx.WS}*type{tx.WS}+{tx.WORD}+{_TYPE_PARAMS}{tx.WS}*=?{tx.WS}*(struct|interface){tx.WS}*)\{{"

_NAME = f"({tx.WORD}+)"
METHOD_NAME = (
    rf"^func{tx.WS}+\({tx.WS}*(?:{tx.WORD}+{tx.WS}+)?\*?{tx.WS}*{_NAME}{tx.WS}*"
    rf"(?:\[[^\]]*\])?{tx.WS}*\){tx.WS}*{_NAME}"
)
FUNC_NAME = rf"^func{tx.WS}+{_NAME}"
TYPE_NAME = rf"^type{tx.WS}+{_NAME}"
PACKAGE_NAME = rf"(?m)^{tx.WS_INLINE}*package{tx.WS_INLINE}+{_NAME}"


def tokens(content: Column) -> Column:
    return F.regexp_extract_all(content, F.lit(LEXER), F.lit(0))


def _blank(token: Column) -> Column:
    """Spaces in place of everything but newlines; most literals have none."""
    return F.when(F.contains(token, F.lit("\n")), F.regexp_replace(token, r"[^\n]", " ")).otherwise(
        F.repeat(F.lit(" "), F.length(token))
    )


def mask(content: Column) -> Column:
    """Blank every literal and comment; length and newlines are kept."""

    def shown(token: Column) -> Column:
        first = F.substring(token, 1, 1)
        # A lone slash is an operator, a longer token that starts with one is a comment.
        literal = first.isin('"', "`", "'") | ((first == "/") & (F.length(token) > 1))
        return F.when(literal, _blank(token)).otherwise(token)

    return F.array_join(F.transform(tokens(content), shown), "")


def package_name(content: Column) -> Column:
    return F.regexp_extract(content, PACKAGE_NAME, 1)


def skeleton(masked: Column) -> Column:
    """What the scan needs of masked text: brackets, newlines and declaration marks.

    Whole-text replacements leave almost nothing of a file, so the work per line is small.
    """
    marked = F.regexp_replace(masked, DECLARATION_START, MARK)
    return F.regexp_replace(marked, rf"[^\n{MARK}(){{}}\[\]]++", "")


def _nesting_change(bones: Column) -> Column:
    without_closers = F.length(F.translate(bones, f"}})]{MARK}", ""))
    without_openers = F.length(F.translate(bones, f"{{([{MARK}", ""))
    return F.when(bones == "", F.lit(0)).otherwise(without_closers - without_openers)


def _line_class(shown: Column, bones: Column) -> Column:
    """Class of a line from its text without indent and its part of the skeleton."""
    # A mark behind a blanked comment does not count: the line itself has to start so.
    starts = F.startswith(shown, F.lit("func ")) | F.startswith(shown, F.lit("type "))
    return (
        F.when(shown == "", F.lit(BLANK))
        .when(F.startswith(shown, F.lit("//")), F.lit(COMMENT))
        .when(F.startswith(bones, F.lit(MARK)) & starts, F.lit(DECLARATION))
        .otherwise(F.lit(OTHER))
    )


def _open_kinds(stack: Column, bones: Column) -> Column:
    """The stack of open brackets, innermost last, after the brackets of one line."""

    def step(held: Column, bracket: Column) -> Column:
        opener = F.translate(bracket, ")}]", "({[")
        nearest = F.when(bracket == ")", tx.position_of_last(held, "("))
        nearest = nearest.when(bracket == "}", tx.position_of_last(held, "{"))
        nearest = nearest.when(bracket == "]", tx.position_of_last(held, "["))
        return (
            F.when(nearest > 0, F.substring(held, F.lit(1), nearest - 1))
            .when(nearest.isNull() & (bracket != MARK) & (opener == bracket), F.concat(held, bracket))
            .otherwise(held)
        )

    return F.aggregate(F.split(bones, ""), stack, step)


def _step(state: Column, line: Column, kinds: bool) -> Column:
    """Advance the scan to the next listed line. Line numbers are 0-based, -1 means none.

    `top` is the first line of the running comment block. One blank line keeps the block
    open; a second one, or any line of code, closes it. A block is also closed when lines
    were left out of the list, which `seen` (the line listed before) tells. `nest` is the depth
    or, with `kinds`, the stack of open brackets; `lost` counts declarations that another one
    broke off.
    """
    here, kind = line["at"], line["kind"]
    adjacent = state["seen"] + 1 == here
    flat = state["nest"] == ("" if kinds else 0)
    opens = (kind == RESTART) | ((state["start"] < 0) & flat & (kind == DECLARATION))
    start = F.when(opens, here).otherwise(state["start"])
    doc = F.when(opens, F.when(adjacent, state["top"]).otherwise(F.lit(-1))).otherwise(state["doc"])
    if kinds:
        nest = _open_kinds(F.when(opens, F.lit("")).otherwise(state["nest"]), line["bones"])
    else:
        nest = F.greatest(F.when(opens, F.lit(0)).otherwise(state["nest"]) + line["change"], F.lit(0))
    top = (
        F.when(kind == COMMENT, F.when(adjacent & (state["top"] >= 0), state["top"]).otherwise(here))
        .when((kind == BLANK) & state["after"] & adjacent, state["top"])
        .otherwise(F.lit(-1))
    )

    def after(nest: Column) -> Column:
        closes = (nest == ("" if kinds else 0)) & (start >= 0)
        span = F.struct(start.alias("start"), here.alias("stop"), doc.alias("doc"))
        return F.struct(
            here.alias("seen"),
            nest.alias("nest"),
            F.when(closes, F.lit(-1)).otherwise(start).alias("start"),
            doc.alias("doc"),
            top.alias("top"),
            (kind == COMMENT).alias("after"),
            (state["lost"] + F.when(opens & (state["start"] >= 0), 1).otherwise(0)).alias("lost"),
            F.when(closes, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return bound(nest, after) if kinds else after(nest)


def bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used. A column of an inner
    select can be inlined by the optimizer, also into a lambda that runs per line."""
    return F.transform(F.array(value), use)[0]


#: Levels of nesting that are taken off at once; deeper files are looked at bracket by bracket.
PEELED = 32
STUCK = "!"


def has_stray_brackets(bones: Column) -> Column:
    """Whether a skeleton's brackets don't all pair up by kind. Innermost pairs are taken off
    whole-text first, which leaves nothing of almost every file."""

    def peel(rest: Column, _: Column) -> Column:
        for pair in ("()", "{}", "[]"):
            rest = F.replace(rest, F.lit(pair), F.lit(""))
        return rest

    def step(held: Column, bracket: Column) -> Column:
        opener = F.translate(bracket, ")}]", "({[")
        return (
            F.when(held == STUCK, held)
            .when(opener == bracket, F.concat(held, bracket))
            .when(F.endswith(held, opener), F.substring(held, F.lit(1), F.length(held) - 1))
            .otherwise(F.lit(STUCK))
        )

    flat = F.translate(bones, f"\n{MARK}", "")
    left = F.aggregate(F.sequence(F.lit(1), F.lit(PEELED)), flat, peel)
    unpaired = bound(left, lambda rest: F.when(rest == "", F.lit("")).otherwise(F.aggregate(F.split(rest, ""), F.lit(""), step)))
    return unpaired != ""


def _classified(lines: Column, bones: Column, *more) -> Column:
    """Lines as (kind, …, at). `more` are further fields, made of the line's text without indent,
    its indent and its part of the skeleton."""
    paired = F.zip_with(
        F.transform(lines, lambda line: F.struct(tx.lstrip(line).alias("shown"), F.length(line).alias("chars"))),
        F.split(bones, "\n", -1),
        lambda line, part: F.struct(
            _line_class(line["shown"], part).alias("kind"),
            *[field(line["chars"] - F.length(line["shown"]), part).alias(name) for name, field in more],
        ),
    )
    names = ["kind", *[name for name, _ in more]]
    return F.transform(paired, lambda line, at: F.struct(*[line[n].alias(n) for n in names], at.alias("at")))


def _counted_lines(lines: Column, bones: Column) -> Column:
    """Without plain code lines that change no nesting, in most files the majority."""
    listed = _classified(lines, bones, ("change", lambda indent, part: _nesting_change(part)))
    return F.filter(listed, lambda line: (line["kind"] != OTHER) | (line["change"] != 0))


def _stacked_lines(lines: Column, bones: Column) -> Column:
    """Declarations with the least indent of all are restarts."""
    listed = _classified(lines, bones, ("indent", lambda indent, part: indent), ("bones", lambda indent, part: part))

    def restarted(listed: Column) -> Column:
        declared = F.filter(listed, lambda line: line["kind"] == DECLARATION)
        least = F.array_min(F.transform(declared, lambda line: line["indent"]))

        def marked(least: Column) -> Column:
            def kind(line: Column) -> Column:
                return F.when((line["kind"] == DECLARATION) & (line["indent"] == least), F.lit(RESTART)).otherwise(line["kind"])

            kept = F.filter(listed, lambda line: (line["kind"] != OTHER) | (line["bones"] != ""))
            return F.transform(
                kept, lambda line: F.struct(kind(line).alias("kind"), line["bones"].alias("bones"), line["at"].alias("at"))
            )

        return bound(least, marked)

    return bound(listed, restarted)


def declaration_scan(lines: Column, masked: Column) -> Column:
    """Struct of `spans`, an array of (start, stop, doc) line spans of the top-level declarations,
    `lost`, the declarations that never close, and `stray`, whether brackets don't pair up."""

    def scanned(bones: Column, stray: Column) -> Column:
        """The stack runs in files with stray brackets alone: only the branch taken is evaluated."""
        return F.when(stray, _scan(_stacked_lines(lines, bones), kinds=True)).otherwise(
            _scan(_counted_lines(lines, bones), kinds=False)
        )

    def result(found: Column, stray: Column) -> Column:
        return F.struct(found["spans"].alias("spans"), found["lost"].alias("lost"), stray.alias("stray"))

    return bound(
        skeleton(masked),
        lambda bones: bound(
            has_stray_brackets(bones), lambda stray: bound(scanned(bones, stray), lambda found: result(found, stray))
        ),
    )


def _scan(listed: Column, kinds: bool) -> Column:
    """Spans and lost declarations. The scan runs over parts of bounded length, so a span is
    copied once per part behind it and not once per declaration."""
    none = F.lit(-1)
    no_spans = F.filter(
        F.array(F.struct(none.alias("start"), none.alias("stop"), none.alias("doc"))),
        lambda s: s["start"] >= 0,
    )
    begin = F.struct(
        none.alias("seen"), F.lit("" if kinds else 0).alias("nest"), none.alias("start"), none.alias("doc"),
        none.alias("top"), F.lit(False).alias("after"), F.lit(0).alias("lost"), no_spans.alias("spans"),
    )
    fields = ("seen", "nest", "start", "doc", "top", "after", "lost")

    def parts(every: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(every) - 1) / SCAN_LINES).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(every, i * SCAN_LINES + 1, SCAN_LINES))

    def scan(state: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(*[state[f].alias(f) for f in fields], no_spans.alias("spans")),
            lambda held, line: _step(held, line, kinds),
            lambda s: F.struct(
                *[s[f].alias(f) for f in fields], F.concat(state["spans"], s["spans"]).alias("spans")
            ),
        )

    def ended(state: Column) -> Column:
        lost = state["lost"] + F.when(state["start"] >= 0, 1).otherwise(0)
        return F.struct(state["spans"].alias("spans"), lost.alias("lost"))

    return F.aggregate(bound(listed, parts), begin, scan, ended)


def _even(head: Column) -> Column:
    """Whether all brackets of a head are closed and no type literal is left open."""
    openers = F.length(F.translate(head, ")}]", ""))
    return (openers == F.length(F.translate(head, "({[", ""))) & ~F.rlike(head, F.lit(r"\b(?:struct|interface)\s*$"))


def _head_by_depth(code: Column) -> Column:
    """Text before the first brace outside brackets that opens no type literal."""
    pieces = F.regexp_extract_all(code, F.lit(r"[^(){}\[\]]*+[(){}\[\]]"), F.lit(0))

    def step(state: Column, piece: Column) -> Column:
        end = state["end"] + F.length(piece)
        bracket = F.substring(piece, -1, 1)
        found = (
            (state["found"] < 0) & (state["depth"] == 0) & (bracket == "{")
            & ~F.rlike(piece, F.lit(r"\b(?:struct|interface)\s*\{$"))
        )
        change = F.when(bracket.isin("(", "{", "["), 1).otherwise(-1)
        return F.struct(
            (state["depth"] + change).alias("depth"), end.alias("end"),
            F.when(found, end - 1).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("end"), F.lit(-1).alias("found"))
    at = F.aggregate(pieces, start, step, lambda s: F.greatest(s["found"], F.lit(0)))
    return F.substring(code, F.lit(1), at)


def _cut(lines: Column, start: Column, stop: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, stop - start + 1), "\n")


def _doc_text(lines: Column, doc: Column, start: Column) -> Column:
    """Comment lines of the block above a declaration, markers removed."""
    block = F.when(doc >= 0, F.slice(lines, doc + 1, start - doc)).otherwise(
        F.array().cast("array<string>")
    )
    comments = F.filter(block, lambda line: F.startswith(tx.lstrip(line), F.lit("//")))
    return F.array_join(
        F.transform(comments, lambda line: tx.lstrip(F.substring(tx.strip(line), 3, 1 << 30))), "\n"
    )


def with_doc(doc: Column, code: Column) -> Column:
    """Declaration text with its comment block put back in front."""
    return F.when(doc == "", code).otherwise(F.concat(tx.comment_lines(doc), F.lit("\n"), code))


def select_paths(files: DataFrame, config: CorpusConfig) -> DataFrame:
    """Code files by path alone; their contents need not be read for it."""
    return files.filter(
        filters.is_code_path(
            F.col("path"), config.include_tests, config.skip_patterns, config.skip_patterns_at_root
        )
    )


def select_contents(files: DataFrame, config: CorpusConfig) -> DataFrame:
    """Drop files with a generator marker, if configured. Contents are decoded once."""
    if not config.skip_generated:
        return files
    return keep_where(files, ~filters.is_generated(F.col("content")), *files.columns)


def select_files(files: DataFrame, config: CorpusConfig) -> DataFrame:
    """The files that units come from, without blank ones, which give none."""
    chosen = select_contents(select_paths(files, config), config)
    return keep_where(chosen, ~tx.is_blank(F.col("content")), *files.columns)


def extract_units(files: DataFrame, accounts: Accounts | None = None) -> DataFrame:
    """Files (source, path, content, module_path) to declaration units.

    Bodyless functions and declarations that never close give no unit. `accounts` gets the files
    with brackets that don't pair up and the declarations that never close.
    """
    parsed = (
        files.select(
            "source", "path", "module_path",
            package_name(F.col("content")).alias("package_name"),
            F.split("content", "\n", -1).alias("lines"),
            mask(F.col("content")).alias("masked"),
        )
        .select(
            "source", "path", "module_path", "package_name", "lines",
            F.split("masked", "\n", -1).alias("masked_lines"),
            declaration_scan(F.col("lines"), F.col("masked")).alias("scan"),
        )
    )
    if accounts:
        parsed = accounts.watch(
            parsed, unbalanced_files=F.count_if("scan.stray"), unclosed_declarations=F.sum("scan.lost")
        )
    cut = F.transform(
        F.col("scan.spans"),
        lambda s: F.struct(
            (s["start"] + 1).alias("line_number"),
            _cut(F.col("lines"), s["start"], s["stop"]).alias("raw"),
            _cut(F.col("masked_lines"), s["start"], s["stop"]).alias("code"),
            _doc_text(F.col("lines"), s["doc"], s["start"]).alias("doc_comment"),
        ),
    )
    pieces = parsed.select(
        "source", "path", "module_path", "package_name", F.explode(cut).alias("d")
    ).select("source", "path", "module_path", "package_name", "d.*")
    return _finish(pieces)


def file_faults(files: DataFrame) -> DataFrame:
    """Per source: code files (source, content, sound) read, those with bytes that weren't text,
    with brackets that don't pair up, and declarations that never close."""
    scanned = files.select(
        "source", "sound", declaration_scan(F.split("content", "\n", -1), mask(F.col("content"))).alias("scan")
    )
    return scanned.groupBy("source").agg(
        F.count("*").alias("files"),
        F.count_if(~F.col("sound")).alias("undecodable_files"),
        F.count_if("scan.stray").alias("unbalanced_files"),
        F.sum("scan.lost").alias("unclosed_declarations"),
    )


def _finish(pieces: DataFrame) -> DataFrame:
    """Name, kind, signature and body of each cut-out declaration."""
    raw, code = F.col("raw"), F.col("code")
    first_line = F.substring_index(raw, "\n", 1)
    is_func = F.startswith(tx.lstrip(code), F.lit("func "))
    tried = pieces.select(
        "*",
        is_func.alias("is_func"),
        F.when(is_func, F.regexp_extract(code, FUNC_HEAD, 1))
        .otherwise(F.regexp_extract(code, TYPE_HEAD, 1))
        .alias("tried"),
    )
    headed = tried.select(
        "*",
        F.when(F.col("is_func") & ~_even(F.col("tried")), _head_by_depth(code)).otherwise(F.col("tried")).alias("head"),
        F.when(~F.col("is_func"), F.regexp_extract(code, TYPE_HEAD, 2)).alias("keyword"),
        tx.position_of_last(code, "}").alias("last"),
    )
    brace = F.length("head") + 1
    has_body = (F.length("head") > 0) & (F.col("last") > F.length("head"))
    shaped = headed.select(
        "source", "path", "module_path", "package_name", "line_number", "doc_comment", "is_func",
        "keyword",
        has_body.alias("has_body"),
        F.when(has_body, F.substring(raw, F.lit(1), F.col("last")))
        .otherwise(tx.strip(first_line))
        .alias("text"),
        F.when(has_body, tx.strip(F.substring(raw, F.lit(1), F.length("head"))))
        .otherwise(tx.strip(first_line))
        .alias("signature"),
        F.when(has_body, tx.strip(F.substring(raw, brace + 1, F.col("last") - brace - 1)))
        .otherwise(F.lit(""))
        .alias("body"),
    )
    method_name = F.regexp_extract("signature", METHOD_NAME, 2)
    named = shaped.select(
        "*",
        F.when(F.col("is_func"), method_name).otherwise(F.lit("")).alias("method_name"),
        F.when(F.col("is_func"), F.regexp_extract("signature", FUNC_NAME, 1))
        .otherwise(F.regexp_extract("signature", TYPE_NAME, 1))
        .alias("plain_name"),
    )
    is_method = F.col("method_name") != ""
    kind = (
        F.when(~F.col("is_func"), F.concat(F.lit("type_"), F.coalesce(F.nullif("keyword", F.lit("")), F.lit("alias"))))
        .when(is_method, F.lit("method"))
        .otherwise(F.lit("func"))
    )
    name = F.when(is_method, F.col("method_name")).otherwise(F.col("plain_name"))
    # A function without a body is declared elsewhere and gives no unit.
    valid = (F.col("has_body") | ~F.col("is_func")) & (name != "")
    return keep_where(
        named,
        valid,
        kind.alias("kind"),
        name.alias("name"),
        "package_name",
        "module_path",
        F.col("path").alias("file_path"),
        F.col("source").alias("project_name"),
        "doc_comment",
        with_doc(F.col("doc_comment"), F.col("text")).alias("code"),
        "signature",
        "body",
        F.when(is_method, F.regexp_extract("signature", METHOD_NAME, 1))
        .otherwise(F.lit(""))
        .alias("receiver_type"),
        F.col("line_number").cast("int").alias("line_number"),
        tx.starts_upper(name).alias("exported"),
    )
