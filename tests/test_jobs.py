"""Sources, sinks, whole jobs and streams on files."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from corpusflow.config import DEFAULT_PROMPT, CorpusConfig, DatasetConfig, SourceConfig
from corpusflow.functions import text as tx
from corpusflow.operators import logs
from corpusflow.plans import corpus
from corpusflow.sources import files, rows
from corpusflow.sources.scratch import scratch_dir
from corpusflow.streaming import jobs

SECTION = "A section that is long enough to be kept. " * 3


def write(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


@pytest.fixture()
def trees(tmp_path):
    code, docs, land = tmp_path / "my code", tmp_path / "docs", tmp_path / "land"
    write(code, "go.mod", "module example.org/top\n")
    write(code, "main.go", b"package main\r\n\r\n// Main runs.\r\nfunc Main() {\r\n\tprintln(\"bad \xff byte, a longer body\")\r\n}\r\n")
    write(code, "util/deep dir/u.go", "package util\n\n// T is.\ntype T struct {\n\tA int // enough text to be kept\n}\n\nfunc (t T) Get() int { return t.A + 1000000000000000000 }\n\nfunc F() {}\n")
    write(code, "util/deep dir/u_test.go", "package util\nfunc TestX() {}\n")
    write(code, "vendor/x/x.go", "package x\nfunc X() {}\n")
    write(code, "gen.go", "// Code generated by x. DO NOT EDIT.\npackage main\nfunc G() {}\n")
    write(docs, "Guide.MD", f"# T\n\n## One\n\n{SECTION}\n\n### *Two*\n\n{SECTION}\n")
    write(docs, "CHANGELOG.md", f"## No\n\n{SECTION}\n")
    write(docs, ".github/x.md", f"## No\n\n{SECTION}\n")
    chats = [{"messages": [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": "a" * i}]} for i in range(30)]
    write(land, "chats/part-0.json", "\n".join(json.dumps(c) for c in chats))
    lines = [
        json.dumps({"conversations": [{"from": "human", "value": "own é"}]}), "", "  ",
        json.dumps({"code": "func f() { " + "y" * 40 + " }"}), json.dumps({"code": "short"}),
    ]
    write(land, "own.jsonl", "\n".join(lines))
    config = CorpusConfig(
        include_tests=False,
        sources=(
            SourceConfig("code", str(code)), SourceConfig("docs", str(docs), "spec", "Guide"),
            SourceConfig("gone", str(tmp_path / "gone")), SourceConfig("odd", str(docs), "pictures"),
        ),
        datasets=(
            DatasetConfig("chats", str(land / "chats"), "table", "messages", "json", max_samples=10),
            DatasetConfig("own", str(land / "own.jsonl")),
            DatasetConfig("missing", str(land / "none.jsonl")),
            DatasetConfig("odd", str(land), "graph"),
        ),
        weights={"code_completion": 1.0, "type_documentation": 1.0},
    )
    return tmp_path, config


def test_tree_scan(spark, trees):
    root, _ = trees
    got = {r.path: r.content for r in files.scan_code(spark, str(root / "my code"), "code").collect()}
    assert set(got) == {"main.go", "util/deep dir/u.go", "util/deep dir/u_test.go", "vendor/x/x.go", "gen.go"}
    assert "\r" not in got["main.go"] and "bad � byte" in got["main.go"]
    assert [r.path for r in files.scan_markdown(spark, str(root / "docs"), "d").collect()] == ["Guide.MD"]


def test_contents_are_not_read_for_paths(spark, trees):
    root, _ = trees
    plan = files.scan_code(spark, str(root / "my code"), "code").select("path")
    text = plan._jdf.queryExecution().executedPlan().toString()
    # The length is needed to skip files that no row can hold.
    assert "ReadSchema: struct<path:string,length:bigint>" in text


def read_lines(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as f:
                out += [json.loads(line) for line in f]
    return out


def test_corpus_job(spark, trees):
    root, config = trees
    out = str(root / "out")
    result = corpus.run_corpus(spark, config, out)
    assert result["examples"] == {"code": 5, "section": 2, "chats": 10, "own": 2, "total": 19}
    counts = result["written"]
    train = read_lines(f"{out}/examples/split=train")
    val = read_lines(f"{out}/examples/split=val")
    # 2 explanations or docs, 2 completions, 1 overview, 2 sections, 10 chats, 2 landed rows
    assert counts == {"train": len(train), "val": len(val), "units": 4} and len(val) == 1
    examples = train + val
    own = [e for e in examples if e["conversations"][0] == {"from": "human", "value": "own é"}]
    assert len(own) == 1
    prompts = [e for e in examples if e["conversations"][0] == {"from": "system", "value": DEFAULT_PROMPT}]
    assert len(prompts) == len(examples) - 1
    answers = [e["conversations"][-1]["value"] for e in examples]
    assert SECTION.strip() in answers and sum(set(a) <= {"a"} for a in answers) == 10
    questions = [e["conversations"][1]["value"] for e in examples if len(e["conversations"]) > 1]
    assert any("example.org/top/util/deep dir" in q for q in questions)
    units = {u["name"]: u for u in read_lines(f"{out}/units")}
    assert set(units) == {"Main", "T", "Get", "F"} and "body" not in units["T"] and "line_number" not in units["T"]
    assert units["Main"]["module_path"] == "example.org/top" and units["Get"]["receiver_type"] == "T"
    with open(next(p for p in _parts(f"{out}/examples")), encoding="utf-8") as f:
        assert "\\u" not in f.read()

    again = str(root / "again")
    assert corpus.run_corpus(spark, config, again) == result
    key = json.dumps
    assert sorted(map(key, read_lines(f"{again}/examples/split=val"))) == sorted(map(key, val))
    assert sorted(map(key, read_lines(f"{again}/examples/split=train"))) == sorted(map(key, train))

    views = corpus.run_training_views(spark, out, str(root / "views"))
    assert views == {"train": len(train), "val": len(val)}
    messages = read_lines(f"{root}/views/messages/split=train")
    assert {m["role"] for e in messages for m in e["messages"]} == {"system", "user", "assistant"}
    assert len(read_lines(f"{root}/views/messages/split=valid")) == 1
    texts = read_lines(f"{root}/views/text/split=train")
    assert all(t["text"].startswith("<|im_start|>") and t["text"].endswith("<|im_end|>\n") for t in texts)


def _parts(path):
    for base, _, names in os.walk(path):
        for n in names:
            if n.startswith("part-"):
                yield os.path.join(base, n)


def test_stats_job(spark, trees):
    _, config = trees
    code, found = corpus.run_stats(spark, config)
    assert [tuple(r) for r in code.collect()] == [("code", 4, 2, 1, 1, 0, 4)]
    assert [tuple(r) for r in found.collect()] == [("docs", 2, 1, 1)]


def test_malformed_lines_fail(spark, tmp_path):
    write(tmp_path, "bad.jsonl", '{"conversations": []}\n{"conversations": [\n')
    with pytest.raises(Exception, match="[Mm]alformed|FAILFAST"):
        rows.read_chats(spark, str(tmp_path / "bad.jsonl")).collect()
    assert rows.read_chats(spark, str(tmp_path / "none.jsonl")).collect() == []


def test_caps_depend_on_rows_alone(spark, tmp_path):
    """The same rows stay under any file layout and split size; repeated rows count one by one."""
    question = F.concat(F.lit("question "), (F.col("id") % 300).cast("string"))
    rows_in = spark.range(900).select(question.alias("question"), F.lit("a").alias("answer"))
    kept = []
    for number, (form, parts, split) in enumerate(
        [("json", 1, "128m"), ("json", 7, "2k"), ("parquet", 3, "128m"), ("parquet", 1, "4k"), ("json", 2, "16k")]
    ):
        path = str(tmp_path / f"landed-{number}")
        rows_in.repartition(parts).write.option("maxRecordsPerFile", 50 if number % 2 else 0).format(form).save(path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            dataset = DatasetConfig("d", path, "table", "qa", form, max_samples=100)
            made = corpus.dataset_examples(spark, dataset, CorpusConfig())
            kept.append(sorted(r.example_id for r in made.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(kept[0]) == 100 and all(k == kept[0] for k in kept)
    assert max(kept[0].count(i) for i in kept[0]) == 3


def test_config():
    config = CorpusConfig.from_dict(
        {
            "system_prompt": "p",
            "sources": [{"name": "a", "url": "u"}, {"name": "b", "path": "/b", "type": "spec", "domain": "D"}],
            "repos": {"dir": "/r"},
            "data": {"include_tests": False, "weights": {"code_completion": 0.2}, "skip_patterns": ["x"]},
            "datasets": [{"name": "d", "type": "table", "format": "qa", "path": "/d", "note": "?"}],
            "training": {"seed": 7, "max_seq_length": 99},
        }
    )
    assert config.sources[0].path == "/r/a" and config.sources[1].domain == "D"
    assert config.weight("code_completion") == 0.2 and config.weight("type_documentation") == 0.8
    assert (config.seed, config.max_seq_length, config.include_tests) == (7, 99, False)
    assert config.datasets[0].max_samples == 0 and config.skip_patterns == ("x",)
    assert CorpusConfig.from_dict(None).system_prompt == DEFAULT_PROMPT


def test_scratch_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(base) and two.startswith(base)


# ---- streams ----


def test_normalize_stream_resumes(spark, tmp_path):
    schema = "conv int, lang string, messages array<struct<role string, content string>>"
    land = tmp_path / "land"

    def arrive(name, ids):
        data = [
            {"conv": i, "lang": "go" if i % 2 else "py",
             "messages": [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": "a"}]}
            for i in ids
        ]
        write(land, name, "\n".join(map(json.dumps, data)))

    def run():
        stream = jobs.normalize_stream(
            spark, str(land), spark.createDataFrame([], schema).schema, "messages", CorpusConfig(),
            "s", "conv", "lang", "go", max_files_per_trigger=1,
        )
        jobs.run_available(stream, str(tmp_path / "out"), str(tmp_path / "check"))
        return sorted(r.example_id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive("a.json", range(4))
    arrive("b.json", range(4, 6))
    assert run() == ["s|1", "s|3", "s|5"]
    assert run() == ["s|1", "s|3", "s|5"]
    arrive("c.json", range(6, 8))
    assert run() == ["s|1", "s|3", "s|5", "s|7"]


LOG = [
    "Loading model",
    "Iter 1: Val loss 2.345, Val took 3s",
    "Iter 10: Train loss 1.250, It/sec 0.512, Tokens/sec 12 \t",
    "  ",
    "Iter  20: Train loss 1.2.3, It/sec .5",
]


def test_log_lines(spark):
    got = logs.parse_log(spark.createDataFrame([(line,) for line in LOG], "value string")).collect()
    assert [tuple(r) for r in got] == [
        (None, None, None, None, "Loading model"),
        (1, None, None, 2.345, None),
        (10, 1.25, 0.512, None, None),
        (20, None, 0.5, None, None),
    ]


def test_log_stream(spark, tmp_path):
    write(tmp_path, "in/log.txt", "\n".join(LOG))
    jobs.run_available(jobs.log_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_lines_are_numbered_by_file(spark, tmp_path):
    """Batch and stream, files of several splits, and progress on what the stream has landed."""
    expected = {}
    for n in range(3):
        lines = [f"Iter {i * 3}: Train loss 1.5, It/sec 2.0" if i % 5 else "" for i in range(400 * n + 7)]
        write(tmp_path, f"in/run {n}.log", "\n".join(lines) + "\n")
        expected |= {(f"run%20{n}.log", i + 1): line for i, line in enumerate(lines)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        jobs.run_available(jobs.line_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"))
        spark.read.text(str(tmp_path / "in")).select(*logs.landed_line()).write.parquet(str(tmp_path / "batch"))
        landed = spark.read.parquet(str(tmp_path / "out"))
        assert landed.select("file", "block").distinct().count() > 6
        name = F.substring_index("file", "/", -1).alias("file")
        for folder in ("out", "batch"):
            found = logs.numbered(spark.read.parquet(str(tmp_path / folder))).select(name, "line", "value").collect()
            assert {(r.file, r.line): r.value for r in found} == expected and len(found) == len(expected)
        metrics = logs.parse_log(logs.numbered(landed).select(name, "line", "value"))
        rows_out = logs.progress(metrics, "file", "line", 50).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # Each fifth line is blank, so progress is 3 from line to line and 6 over the blank ones.
    assert {(r.line - 1) % 5: r.advance for r in rows_out if r.line > 7} == {1: 6, 2: 3, 3: 3, 4: 3}


def test_jsonl_stream_equals_batch_after_restarts(spark, tmp_path):
    def arrive(name, ids):
        data = [{"conversations": [{"from": "human", "value": f"q{i}", "w": i}], "id": i} if i % 2 else {"code": f"func f{i}() {{ {'y' * 40} }}"} for i in ids]
        write(tmp_path, f"land/{name}", "\n".join(map(json.dumps, data)) + "\n\n")

    def run():
        stream = jobs.jsonl_stream(spark, str(tmp_path / "land"), CorpusConfig(), "own", max_files_per_trigger=1)
        jobs.run_available(stream, str(tmp_path / "out"), str(tmp_path / "check"))
        return sorted((r.example_id, r.raw) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive("a.jsonl", range(6))
    arrive("b.jsonl", range(6, 9))
    first = run()
    assert len(first) == 9 and run() == first
    # A restart that has lost its last commit does the batch again, and nothing comes twice.
    commit = max((tmp_path / "check/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    os.remove(commit)
    for crc in (tmp_path / "check/commits").glob(f".{commit.name}.crc"):
        os.remove(crc)
    arrive("c.jsonl", range(9, 12))
    got = run()
    batch = corpus.dataset_examples(spark, DatasetConfig("own", str(tmp_path / "land")), CorpusConfig())
    assert got == sorted((r.example_id, r.raw) for r in batch.collect()) and len(got) == 12


def test_parquet_stream(spark, tmp_path):
    rows_in = spark.createDataFrame([(i, [("user", f"q{i}"), ("assistant", "a")]) for i in range(5)], "conv int, messages array<struct<role string, content string>>")
    rows_in.write.parquet(str(tmp_path / "in"))
    stream = jobs.normalize_stream(spark, str(tmp_path / "in"), rows_in.schema, "messages", CorpusConfig(), "s", "conv", file_format="parquet")
    jobs.run_available(stream, str(tmp_path / "out"))
    assert sorted(r.example_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"s|{i}" for i in range(5)]


def test_progress_crosses_groups_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(logs, "FAN", 3)
    metrics = spark.createDataFrame([("r", i, i * i if i % 11 == 0 else None) for i in range(400)], "run string, line int, iteration bigint")
    for chunk in (1, 4):
        got = {r.line: r.advance for r in logs.progress(metrics, "run", "line", chunk).collect()}
        assert got == {i: i * i - (i - 11) ** 2 if i else 0 for i in range(0, 400, 11)}


def test_progress_crosses_chunks(spark):
    values = [(("hot" if i % 3 else "cold"), i, (i * 7) % 50 if i % 4 else None) for i in range(200)]
    metrics = spark.createDataFrame(values, "run string, line int, iteration bigint")
    expected, last = {}, {}
    for run, line, iteration in values:
        if iteration is not None:
            expected[(run, line)] = iteration - last.get(run, 0)
            last[run] = iteration
    for chunk in (1, 7, 1000):
        rows = logs.progress(metrics, "run", "line", chunk).collect()
        assert {(r.run, r.line): r.advance for r in rows} == expected


def test_hidden_names_are_scanned(spark, tmp_path):
    for name in ("_examples/x/a.go", "pkg/_b.go", ".ci/d.go", "pkg/c.go", "_o/.p/_q.go", "pkg/.hidden.txt", "a [b]/_e.go"):
        write(tmp_path, name, f"package {name}")
    got = {r.path: r.content for r in files.scan_code(spark, str(tmp_path), "s").collect()}
    assert set(got) == {"_examples/x/a.go", "pkg/_b.go", ".ci/d.go", "pkg/c.go", "_o/.p/_q.go", "a [b]/_e.go"}
    assert all(got[p] == f"package {p}" for p in got)


def test_oversized_files_are_skipped_and_listed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MAX_FILE_BYTES", 10)
    write(tmp_path, "a.go", "short")
    write(tmp_path, "_x/b.go", "much longer than that")
    assert [r.path for r in files.scan_code(spark, str(tmp_path), "s").collect()] == ["a.go"]
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in files.oversized_files(spark, str(tmp_path)).collect()] == [("b.go", 21)]


def test_staged_folders_are_removed(spark, trees):
    from corpusflow.sources.scratch import CHECKPOINT_SETTING

    root, config = trees
    base = spark.conf.get(CHECKPOINT_SETTING)
    before = set(os.listdir(base))
    corpus.run_corpus(spark, config, str(root / "clean"), ordered=False)
    assert set(os.listdir(base)) == before


def test_landed_table_gives_the_same_corpus(spark, trees):
    from dataclasses import replace

    root, config = trees
    scanned = files.scan_tree(spark, str(root / "my code"), "code").unionByName(files.scan_tree(spark, str(root / "docs"), "docs"))
    other = spark.createDataFrame([("stranger", "x.go", "package x\nfunc X() { return 1 }\n")], files.FILE_SCHEMA)
    scanned.unionByName(other).write.parquet(str(root / "landed"))
    result = corpus.run_corpus(spark, config, str(root / "a"))
    assert corpus.run_corpus(spark, replace(config, landed_files=str(root / "landed")), str(root / "b")) == result
    for part in ("examples/split=train", "examples/split=val", "units"):
        a, b = (sorted(map(json.dumps, read_lines(f"{root}/{o}/{part}"))) for o in "ab")
        assert a == b


def test_chats_keep_all_their_fields(spark, tmp_path):
    line = '{"id": 7, "conversations": [{"from": "human", "value": "q", "weight": 0.5}], "more": {"x": [1]}}'
    write(tmp_path, "own.jsonl", line + "\n" + json.dumps({"code": "func f() { " + "y" * 40 + " }"}))
    config = CorpusConfig(datasets=(DatasetConfig("own", str(tmp_path / "own.jsonl")),))
    corpus.run_corpus(spark, config, str(tmp_path / "out"))
    written = read_lines(f"{tmp_path}/out/examples/split=train") + read_lines(f"{tmp_path}/out/examples/split=val")
    assert json.loads(line) in written and len(written) == 2


def test_filter_fields_have_their_own_type(spark, tmp_path):
    path = str(tmp_path / "typed")
    spark.range(10).select(F.col("id").cast("int").alias("stars"), F.lit("q").alias("question"), F.lit("a").alias("answer")).write.parquet(path)
    for value, n in ((3, 1), ("3", 1), ("x", 0), (None, 0)):
        dataset = DatasetConfig("d", path, "table", "qa", filter_field="stars", filter_value=value)
        assert corpus.dataset_examples(spark, dataset, CorpusConfig()).count() == n
    missing = DatasetConfig("d", path, "table", "qa", filter_field="none", filter_value=1)
    assert corpus.dataset_examples(spark, missing, CorpusConfig()).count() == 0


def test_settings_find_paths_and_names():
    raw = {
        "sources": [{"name": "a"}, {"name": "b", "path": "/abs"}, {"name": "c", "path": "s3a://x/y"}],
        "datasets": [{"type": "jsonl"}, {"path": "own.jsonl"}, {"name": "n"}],
    }
    config = CorpusConfig.from_dict(raw, "/conf")
    assert [s.path for s in config.sources] == ["/conf/repos/a", "/abs", "s3a://x/y"]
    assert [(d.name, d.path) for d in config.datasets] == [
        ("dataset-0", "/conf/datasets/dataset-0"), ("dataset-1", "/conf/own.jsonl"), ("n", "/conf/datasets/n")
    ]
    with pytest.raises(ValueError, match="dataset names must differ: n"):
        CorpusConfig.from_dict({"datasets": [{"name": "n"}, {"name": "n"}]})


def test_unknown_sources_are_counted(spark):
    from corpusflow.sources import catalog

    listed = catalog.source_table(spark, [SourceConfig("a", "")])
    rows_in = spark.createDataFrame([("a",), ("b",), ("b",)], "source string")
    assert [tuple(r) for r in catalog.unknown_sources(rows_in, listed).collect()] == [("b", 2)]


def sizes_of(path):
    return {p.removeprefix(path): os.path.getsize(p) for p in _parts(path)}


def test_compressed_outputs(spark, trees):
    """Compressed parts hold the rows of plain ones in fewer bytes, also where chats keep their line."""
    root, config = trees
    packed = CorpusConfig.from_dict({"data": {"output_compression": "gzip"}})
    assert packed.output_compression == "gzip" and config.output_compression is None
    made = corpus.run_corpus(spark, config, f"{root}/plain")
    assert corpus.run_corpus(spark, replace(config, output_compression="gzip"), f"{root}/packed") == made
    corpus.run_training_views(spark, f"{root}/plain", f"{root}/plain-views")
    views = corpus.run_training_views(spark, f"{root}/packed", f"{root}/packed-views", "gzip")
    assert sum(views.values()) == made["written"]["train"] + made["written"]["val"]
    for part in ("/examples/split=train", "/examples/split=val", "/units", "-views/messages", "-views/text"):
        plain, small = sizes_of(f"{root}/plain{part}"), sizes_of(f"{root}/packed{part}")
        assert all(p.endswith(".gz") for p in small) and not any(p.endswith(".gz") for p in plain)
        lines = [sorted(r.value for r in spark.read.text(f"{root}/{name}{part}").collect()) for name in ("plain", "packed")]
        assert lines[0] == lines[1] and lines[0]
    assert sum(sizes_of(f"{root}/packed").values()) < sum(sizes_of(f"{root}/plain").values())
