"""Hand-written source files with explicit expected units."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.config import CorpusConfig
from corpusflow.operators import code_units as cu

EDGE = '''// Package header.

package demo

import (
	"fmt"
	"os"
)

var text = `
func Hidden() {
type Fake struct {
`

/* block
func AlsoHidden() {
}
*/

// Open reads a file
// with { braces }.
func Open(
	name string,
	opt struct{ A int },
	cb func() error,
) (int, error) {
	r, q := '{', '\\''
	s := "a } \\" {" // } {
	if r == q {
		fmt.Println(s, `}`)
	}
	return 1, nil
}

// Lone.


func NoDoc() interface{} {
	return struct{ X int }{1}
}

// First.

// Second.

func (b *Box[T]) Get(in interface {
	Close() error
}) (
	out T,
) {
	type inner struct {
		a int
	}
	return b.v
}

func (Box) unnamed() {}

func asm(x, y int) int

type Empty struct{}

type Pair[K comparable, V any] struct {
	// note }
	Key K `json:"{k"`
	Val struct {
		N int
	}
}

type Doer interface {
	Do(a interface{}) error
}

type Set map[string]struct{}

type Cb func(a struct{},
	b int) error

type (
	One struct {
		A int
	}
	Two int
)

func run(f func()) { f() }

func main() {
	go func() {
	}()
}
'''


def units_of(spark, *contents):
    files = spark.createDataFrame(
        [("p", f"f{i}.go", c, "m") for i, c in enumerate(contents)],
        "source string, path string, content string, module_path string",
    )
    return cu.extract_units(files).orderBy("file_path", "line_number").collect()


def test_edge_file(spark):
    units = {u.name: u for u in units_of(spark, EDGE)}
    assert list(units) == [
        "Open", "NoDoc", "Get", "unnamed", "Empty", "Pair", "Doer", "Set", "Cb", "run", "main",
    ]
    assert {u.package_name for u in units.values()} == {"demo"}
    kinds = {n: u.kind for n, u in units.items()}
    assert kinds == {
        "Open": "func", "NoDoc": "func", "Get": "method", "unnamed": "method",
        "Empty": "type_struct", "Pair": "type_struct", "Doer": "type_interface",
        "Set": "type_alias", "Cb": "type_alias", "run": "func", "main": "func",
    }
    lines = EDGE.split("\n")
    for u in units.values():
        assert lines[u.line_number - 1].lstrip().startswith(("func", "type"))
        assert u.name in lines[u.line_number - 1]
        assert u.exported == u.name[0].isupper()
    opened = units["Open"]
    assert opened.doc_comment == "Open reads a file\nwith { braces }."
    assert opened.signature.endswith(") (int, error)") and "struct{ A int }" in opened.signature
    assert opened.body.startswith("r, q := ") and opened.body.endswith("return 1, nil")
    start = EDGE.index("func Open")
    assert opened.code == (
        "// Open reads a file\n// with { braces }.\n"
        + EDGE[start : EDGE.index("}\n\n// Lone") + 1]
    )
    assert units["NoDoc"].doc_comment == ""
    assert units["NoDoc"].signature == "func NoDoc() interface{}"
    assert units["NoDoc"].body == "return struct{ X int }{1}"
    got = units["Get"]
    assert got.receiver_type == "Box" and got.doc_comment == "First.\nSecond."
    assert got.signature.endswith("out T,\n)") and got.body.endswith("return b.v")
    assert units["unnamed"].receiver_type == "Box" and units["unnamed"].body == ""
    assert units["Empty"].code == "type Empty struct{}" and units["Empty"].body == ""
    assert units["Pair"].signature == "type Pair[K comparable, V any] struct"
    assert units["Pair"].body.startswith("// note }") and units["Pair"].body.endswith("}")
    assert units["Doer"].body == "Do(a interface{}) error"
    assert units["Set"].code == units["Set"].signature == "type Set map[string]struct{}"
    assert units["Cb"].code == "type Cb func(a struct{},"
    assert units["run"].body == "f()" and units["main"].body == "go func() {\n\t}()"


def test_files_without_units(spark):
    assert units_of(spark, "package a\n\nfunc broken() {\n", "package a", "}\n") == []


def test_stray_closer_does_not_hide_later_units(spark):
    assert [u.name for u in units_of(spark, "package a\n}\nfunc ok() { return }\n")] == ["ok"]


def _fragments(rng):
    pieces = [
        '"', "'", "`", "//", "/*", "*/", "\n", "{", "}", "\\", "a", "é", "𝒳", " ", '"x\\""', "'\\''",
    ]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))


def test_lexing_is_lossless_and_masking_keeps_shape(spark):
    rng = random.Random(3)
    texts = [_fragments(rng) for _ in range(400)]
    rows = (
        spark.createDataFrame([(t,) for t in texts], "t string")
        .select("t", F.array_join(cu.tokens(F.col("t")), "").alias("joined"), cu.mask(F.col("t")).alias("m"))
        .collect()
    )
    for r in rows:
        assert r.joined == r.t
        assert len(r.m) == len(r.t)
        assert [i for i, c in enumerate(r.m) if c == "\n"] == [i for i, c in enumerate(r.t) if c == "\n"]


def test_long_literals_do_not_overflow(spark):
    literal = '"' + "\\x1f" * 200_000 + '"'
    content = f"package a\n\nvar blob = {literal}\n\nfunc After() {{ return }}\n"
    assert [u.name for u in units_of(spark, content)] == ["After"]


def _python_doc(lines, decl):
    """The doc rule as a pattern over line kinds: comments, each with at most one blank after."""
    kinds = ""
    for line in lines[:decl]:
        text = line.strip()
        kinds += "c" if text.startswith("//") else "x" if text else "b"
    block = re.search("(?:cb?)*$", kinds).start()
    shown = [line.strip() for line in lines[block:decl]]
    return "\n".join(text[2:].lstrip() for text in shown if text)


def test_doc_comments_match_the_rule(spark):
    rng = random.Random(5)
    contents = []
    for n in range(60):
        lines = ["package a"]
        for d in range(4):
            for _ in range(rng.randrange(7)):
                lines.append(rng.choice(["", "  ", "// c%d" % rng.randrange(9), "\t//", "var v int"]))
            lines.append(f"func F{d}() {{}}")
        contents.append("\n".join(lines))
    units = units_of(spark, *contents)
    assert len(units) == 240
    for u in units:
        lines = contents[int(u.file_path[1:-3])].split("\n")
        assert u.doc_comment == _python_doc(lines, u.line_number - 1), lines


def test_file_selection(spark):
    marker = "// Code Generated by x. DO NOT EDIT."
    files = spark.createDataFrame(
        [
            ("p", "a/ok.go", "package a"),
            ("p", "a/late.go", "\n" * 6 + marker),
            ("p", "a/marked.go", "\n" * 5 + marker),
            ("p", "a/blank.go", " \n "),
            ("p", "a/x_test.go", "package a"),
            ("p", "vendor/x.go", "package a"),
            ("p", "a/hack/x.go", "package a"),
            ("p", "a/hacks/x.go", "package a"),
            ("p", "a/b.pb.go", "package a"),
            ("p", "root.pb.go", "package a"),
            ("p", "a/readme.md", "package a"),
        ],
        "source string, path string, content string",
    )

    def kept(**kw):
        return sorted(r.path for r in cu.select_files(files, CorpusConfig(**kw)).collect())

    base = ["a/b.pb.go", "a/hacks/x.go", "a/late.go", "a/ok.go", "root.pb.go"]
    assert kept(include_tests=False) == base
    assert kept() == sorted([*base, "a/x_test.go"])
    globs = ("**/*.pb.go",)
    assert "root.pb.go" in kept(skip_patterns=globs) and "a/b.pb.go" not in kept(skip_patterns=globs)
    assert "root.pb.go" not in kept(skip_patterns=globs, skip_patterns_at_root=True)
    assert "a/marked.go" in kept(skip_generated=False)


def test_extraction_needs_no_shuffle(spark):
    files = spark.createDataFrame(
        [("p", "f.go", EDGE, "m")], "source string, path string, content string, module_path string"
    )
    plan = cu.extract_units(files)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_any_nesting_of_type_literals(spark):
    deep = "struct{ a int }"
    for _ in range(7):
        deep = f"struct {{ a {deep} }}"
    text = f"package d\n\nfunc f(a {deep}) {{\n\treturn 1\n}}\n\nfunc g() {deep} {{\n\tx(1)\n}}\n\nfunc h() int {{ return 2 }}\n"
    got = {u.name: (u.signature, u.body) for u in units_of(spark, text)}
    assert got == {"f": (f"func f(a {deep})", "return 1"), "g": (f"func g() {deep}", "x(1)"), "h": ("func h() int", "return 2")}


def test_one_stray_bracket_costs_one_declaration(spark):
    text = "package d\n\nvar x = (1\n\nfunc A() {\n\ta()\n}\n\nfunc B() {\n\tb([)\n}\n\n// C is.\nfunc C() {\n\tc()\n}\n"
    got = {u.name: u for u in units_of(spark, text)}
    assert {"A", "C"} <= set(got) and got["C"].doc_comment == "C is." and got["A"].body == "a()"


FUNCTIONS = "func A() {\n\ta()\n}\n\nfunc B() {\n\tb()\n}\n"


@pytest.mark.parametrize(
    "text",
    [
        "package d\n}\nvar x = (1\n\n" + FUNCTIONS,  # even by count, not by order and kind
        "package d\n\n(\n\n" + "\n".join("  " + line for line in FUNCTIONS.split("\n")),  # all indented
        "package d\n\nvar x = ([1)]\n\n" + FUNCTIONS,
        "package d\n)\n" + FUNCTIONS + "{[(\n",
        "package d\n\n" + FUNCTIONS.replace("a()", "a(]"),
        "package d\n\n" + FUNCTIONS.replace("a()", "a([)"),
        "package d\n\nfunc Lost() {\n\tif x {\n\n" + FUNCTIONS,
    ],
)
def test_brackets_of_wrong_kind_or_order_hide_no_unit(spark, text):
    got = {u.name: u for u in units_of(spark, text)}
    assert set(got) == {"A", "B"} and got["B"].body == "b()"


PAIRS = {")": "(", "}": "{", "]": "["}


def _python_spans(lines):
    """Spans, declarations that never close and whether brackets pair up, line by line. A closer
    closes the nearest opener of its kind. The least indented declarations start anew in a file
    whose brackets don't pair up."""
    stack, stray = [], False
    for c in "".join(lines):
        if c in "({[":
            stack.append(c)
        elif c in PAIRS:
            stray |= not stack or stack.pop() != PAIRS[c]
    stray |= bool(stack)
    declares = [bool(re.match(r"\s*(func |type (?!\())", line)) for line in lines]
    indents = [len(line) - len(line.lstrip()) for line in lines]
    least = min([i for i, d in zip(indents, declares) if d], default=0)
    stack, start, spans, lost = "", None, [], 0
    for at, line in enumerate(lines):
        anew = stray and declares[at] and indents[at] == least
        if anew or (start is None and not stack and declares[at]):
            lost += start is not None
            stack, start = "", at
        for c in line:
            if c in "({[":
                stack += c
            elif c in PAIRS and PAIRS[c] in stack:
                stack = stack[: stack.rindex(PAIRS[c])]
        if start is not None and not stack:
            spans.append((start, at))
            start = None
    return spans, lost + (start is not None), stray


def test_scan_of_any_brackets(spark):
    rng = random.Random(5)
    kinds = ["func F() {", "}", "}", "  func G(a [", "] int) {", "type T struct {", "x(", ")", "])", "({", "})", "y", "", "  }", "\ttype U int", "a[{(1)}]"]
    files = [[rng.choice(kinds) for _ in range(rng.randint(0, 14))] for _ in range(1500)]
    files += [["func F() {", "x" + "(" * 60, ")" * 60, "}"], ["func F() {"] * 300 + ["}"]]
    df = spark.createDataFrame([(i, "\n".join(f)) for i, f in enumerate(files)], "i int, content string")
    scan = cu.declaration_scan(F.split("content", "\n", -1), cu.mask(F.col("content")))
    for row in df.repartition(8).select("i", scan.alias("scan")).collect():
        got = [(s.start, s.stop) for s in row.scan.spans], row.scan.lost, row.scan.stray
        assert got == _python_spans("\n".join(files[row.i]).split("\n")), files[row.i]


def test_scan_is_linear_in_declarations(spark):
    """Twice the declarations take about twice the time, and all are found."""
    import time

    def seconds(n):
        text = "package d\n" + "".join(f"// D{i} is.\nfunc D{i}() {{\n\tcall({i})\n}}\n\n" for i in range(n))
        files = spark.createDataFrame([("p", "f.go", text, "m")], "source string, path string, content string, module_path string")
        start = time.perf_counter()
        assert cu.extract_units(files).count() == n
        return time.perf_counter() - start

    seconds(500)
    small, large = min(seconds(8_000) for _ in range(2)), seconds(32_000)
    assert large < 4 * 2.5 * small
