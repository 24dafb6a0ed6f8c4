"""Generators and normalisers on hand-written rows and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.config import CorpusConfig
from corpusflow.functions import chat
from corpusflow.operators import chat_views, examples, modules, normalize, packages

CONFIG = CorpusConfig(system_prompt="sys")


def unit(**kw):
    base = dict(
        kind="func", name="Run", package_name="p", module_path="m/p", file_path="a.go", project_name="pr",
        doc_comment="Doc.", code="// Doc.\nfunc Run() {" + "x" * 60 + "}", signature="func Run()",
        body="x" * 60, receiver_type="", line_number=3, exported=True,
    )
    base.update(kw)
    return tuple(base[f.name] for f in schemas.UNIT)


def made(spark, *units, **config):
    df = spark.createDataFrame(list(units), schemas.UNIT)
    rows = examples.unit_examples(df, CorpusConfig(system_prompt="sys", weights={"code_completion": 1.0, "type_documentation": 1.0}, **config))
    return {r.example_type: [t.value for t in r.conversations] for r in rows.collect()}


def test_function_examples(spark):
    got = made(spark, unit())
    assert set(got) == {"code_explanation", "code_completion"}
    prompt, question, answer = got["code_explanation"]
    assert prompt == "sys" and "function `Run`" in question and "`m/p`" in question and "pr" in question
    assert question.endswith("\n\n```go\n// Doc.\nfunc Run() {" + "x" * 60 + "}\n```")
    doc, place, signature = answer.split("\n\n")
    assert doc == "Doc." and "`a.go`" in place and "`p`" in place and signature.endswith("`func Run()`")
    _, question, answer = got["code_completion"]
    assert question.endswith("\n\n```go\n// Doc.\nfunc Run() {\n```") and answer == "```go\n" + "x" * 60 + "\n```"


def test_generator_limits(spark):
    assert set(made(spark, unit(doc_comment=""))) == {"code_completion"}
    assert set(made(spark, unit(body="x" * 29))) == {"code_explanation"}
    assert "code_completion" in made(spark, unit(body="x" * 30))
    for size, kept in ((49, False), (50, True), (4096, True), (4097, False)):
        assert bool(made(spark, unit(code="c" * size))) is kept
    assert made(spark, unit(kind="type_alias", doc_comment="")) == {}


def test_type_documentation_counts_members(spark):
    body = "A int\n\n  // note\n\tB string // tail\n"
    got = made(spark, unit(kind="type_struct", body=body))
    assert set(got) == {"type_documentation"}
    assert got["type_documentation"][2].endswith("\n\nThe type has 2 fields.")
    got = made(spark, unit(kind="type_interface", body="Do()"))
    assert got["type_documentation"][2].endswith("1 methods.")
    got = made(spark, unit(kind="type_struct", body="// only"))
    assert "has" not in got["type_documentation"][2]


def test_weights_gate_and_sample(spark):
    df = spark.createDataFrame([unit(line_number=i) for i in range(400)], schemas.UNIT)

    def counts(**kw):
        rows = examples.unit_examples(df, CorpusConfig(**kw)).groupBy("example_type").count().collect()
        return {r.example_type: r["count"] for r in rows}

    got = counts(weights={"code_explanation": 0.1, "code_completion": 0.5})
    assert got["code_explanation"] == 400 and 150 < got["code_completion"] < 250
    got = counts(weights={"code_explanation": 0.1, "code_completion": 0.0}, sample_all=True)
    assert set(got) == {"code_explanation"} and got["code_explanation"] < 80


def _python_package(members):
    members = sorted(members, key=lambda u: (u["file_path"], u["line_number"]))
    docs = [u["doc_comment"] for u in members if u["doc_comment"] and u["kind"] == "func" and u["name"] == "init"]
    docs += [u["doc_comment"] for u in members if u["doc_comment"]]
    types = [u["name"] for u in members if u["kind"].startswith("type_") and u["exported"]]
    funcs = [u["name"] for u in members if u["kind"] in ("func", "method") and u["exported"]]
    files = [f.split("/")[-1] for f in sorted({u["file_path"] for u in members})]
    return (
        len(members), len(types), len(funcs), docs[0][:500] if docs else None,
        ", ".join(files[:15]), ", ".join(types[:12]), ", ".join(funcs[:12]),
    )


def test_package_summary_matches_brute_force(spark):
    """One hot package with a third of all units and many files, next to small ones."""
    rng = random.Random(11)
    names = [f.name for f in schemas.UNIT]
    units, groups = [], {}
    for i in range(1500):
        hot = i % 3 == 0
        pkg = "hot" if hot else f"p{rng.randrange(300)}"
        row = unit(
            kind=rng.choice(["func", "method", "type_struct", "type_alias"]),
            name="init" if rng.random() < 0.02 else f"N{i}", package_name=pkg,
            file_path=f"d/{pkg}_{rng.randrange(90 if hot else 2)}.go", line_number=i,
            exported=rng.random() < 0.6, doc_comment=rng.choice(["", "", f"doc {i} " * 90]),
        )
        units.append(row)
        groups.setdefault(pkg, []).append(dict(zip(names, row)))
    df = spark.createDataFrame(units, schemas.UNIT).repartition(8)
    got = {
        r.package_name: (r.n_units, r.n_types, r.n_functions, r.doc, r.files, r.types, r.functions)
        for r in packages.package_summary(df).collect()
    }
    assert got == {p: _python_package(m) for p, m in groups.items() if len(m) >= 3}


def test_package_example_without_doc(spark):
    df = spark.createDataFrame(
        [unit(doc_comment="", exported=False, line_number=i) for i in range(3)], schemas.UNIT
    )
    (row,) = packages.package_examples(df, CONFIG).collect()
    assert row.conversations[2].value == "Package `p` belongs to pr and is imported as `m/p`.\n\nFiles: a.go"


def test_messages(spark):
    rows = spark.createDataFrame(
        [
            (1, [("system", "own"), ("user", " hi "), ("assistant", "yo"), ("tool", "t")]),
            (2, [("user", "hi"), ("assistant", " \n")]),
            (3, [("user", "hi"), (None, "x"), ("assistant", None), ("human", "again")]),
            (4, []),
            (5, None),
        ],
        "id int, messages array<struct<role string, content string>>",
    )
    got = {
        r.example_id: [(t["from"], t["value"]) for t in r.conversations]
        for r in normalize.normalize(rows, "messages", CONFIG, "o", F.col("id")).collect()
    }
    assert got == {
        "o|1": [("system", "sys"), ("human", " hi "), ("gpt", "yo"), ("tool", "t")],
        "o|3": [("system", "sys"), ("human", "hi"), ("human", "again")],
    }
    dropped = rows.filter("id = 3").select(normalize.dropped_messages(F.col("messages")).alias("n"))
    assert dropped.first().n == 2


def test_pairs_take_the_first_filled_key(spark):
    keys = (*schemas.QUESTION_KEYS["qa"], *schemas.ANSWER_KEYS["qa"])
    rows = spark.createDataFrame(
        [
            ("a", "", " q ", None, None, "a\n", None),
            ("b", " ", "q", None, "a", None, None),  # blank text hides the later key
            ("c", None, None, "p", "", "", "r"),
            ("d", "q", None, None, None, None, None),
        ],
        ", ".join(f"{k} string" for k in ("id", *keys)),
    )
    got = {
        r.example_id: (r.conversations[1].value, r.conversations[2].value)
        for r in normalize.normalize(rows, "qa", CONFIG, "o", F.col("id")).collect()
    }
    assert got == {"o|a": ("q", "a"), "o|c": ("p", "r")}


@pytest.mark.parametrize(
    "code, doc, expected",
    [
        ("x" * 39, "d" * 31, None),
        ("x" * 40, "d" * 31, "d" * 31),
        ("x" * 40, "d" * 30, None),
        ("func f() { " + "y" * 20 + " } // xxxx", "d" * 30, "```go\n" + "y" * 20 + "\n```"),
        ("func f() { " + "y" * 19 + " } // xxxxx", "", None),
        ("} " + "y" * 50 + " {", "", None),
        ("func f() {" + "y" * 5000 + "}", "", None),  # the cut removes the closing brace
        ("func f() {}" + " " * 40, " " * 31 + "d", "d"),
        ("func f() {}" + " " * 40, "d" * 3000, "d" * 2000),
    ],
)
def test_code_pairs(spark, code, doc, expected):
    rows = spark.createDataFrame([(1, code, doc)], "id int, content string, comment string")
    got = normalize.normalize(rows, "code", CONFIG, "o", F.col("id")).collect()
    assert [r.conversations[2].value for r in got] == ([] if expected is None else [expected])
    if got and expected.startswith("```"):
        assert got[0].conversations[1].value.endswith("```go\nfunc f() {\n```")


def test_jsonl_rows(spark):
    rows = spark.createDataFrame(
        [(1, [("human", "h")], None), (2, None, "func f() { " + "y" * 40 + " }")],
        "id int, conversations array<struct<`from` string, value string>>, code string",
    )
    got = {r.example_id: [t.value for t in r.conversations] for r in normalize.normalize_jsonl(rows, CONFIG, "j", F.col("id")).collect()}
    assert got["j|1"] == ["h"] and got["j|2"][0] == "sys" and len(got["j|2"]) == 3


def test_role_maps_are_inverse(spark):
    rows = spark.createDataFrame(
        [([("system", "s"), ("human", "h"), ("gpt", "g"), ("tool", "t")],)],
        "conversations array<struct<`from` string, value string>>",
    )
    back = rows.select(chat.to_conversations(chat.to_messages(F.col("conversations"))).alias("c"), "conversations").first()
    assert back.c == back.conversations


def test_spans_cut_out_the_answers(spark):
    turns = [("system", "s"), ("human", "h𝒳"), ("gpt", "one"), ("gpt", ""), ("human", "q"), ("gpt", "two\n")]
    df = spark.createDataFrame([("e", turns)], "example_id string, conversations array<struct<`from` string, value string>>")
    text = chat_views.render_text(df).first().text
    spans = chat_views.response_spans(df).orderBy("turn").collect()
    assert [(s.turn, text[s.start : s.stop]) for s in spans] == [
        (2, "one<|im_end|>\n"), (3, "<|im_end|>\n"), (5, "two\n<|im_end|>\n"),
    ]
    profile = chat_views.length_profile(df, CorpusConfig(max_seq_length=10)).first()
    assert profile.chars == len(text) and profile.est_tokens == -(-len(text) // 4) and profile.over_budget


def test_prompts_leave_the_answer_open(spark):
    df = spark.createDataFrame([("why?",)], "q string")
    assert chat_views.render_prompts(df, "q", CONFIG).first().prompt == (
        "<|im_start|>system\nsys<|im_end|>\n<|im_start|>user\nwhy?<|im_end|>\n<|im_start|>assistant\n"
    )


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_nearest_module(spark, threshold):
    files = spark.createDataFrame(
        [("s", p) for p in ("main.go", "a/x.go", "a/b/c/x.go", "ab/x.go", "z/y/x.go")] + [("t", "x.go"), ("t", "q/x.go")],
        "source string, path string",
    )
    manifests = modules.read_manifests(
        spark.createDataFrame(
            [
                ("s", "go.mod", "// c\nmodule root.org/s // x\nmodule later\n"),
                ("s", "a/b/go.mod", "go 1.2\nmodule\n  nested.org/b\n"),
                ("s", "z/go.mod", "no name here"),
                ("t", "q/notgo.mod", "module wrong"),
            ],
            "source string, path string, content string",
        )
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = modules.attach_modules(files, manifests).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.source, r.path): r.module_path for r in rows} == {
        ("s", "main.go"): "root.org/s", ("s", "a/x.go"): "root.org/s/a",
        ("s", "a/b/c/x.go"): "nested.org/b/c", ("s", "ab/x.go"): "root.org/s/ab",
        ("s", "z/y/x.go"): "root.org/s/z/y", ("t", "x.go"): ".", ("t", "q/x.go"): "q",
    }
