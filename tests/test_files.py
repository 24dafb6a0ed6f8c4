"""Listings and contents read in tasks, outputs that are replaced, datasets of one kind."""

import json
import os
from dataclasses import replace

import pytest


from corpusflow.config import CorpusConfig, DatasetConfig, SourceConfig
from corpusflow.operators import modules
from corpusflow.operators.accounts import Accounts
from corpusflow.plans import corpus
from corpusflow.sources import commits, files, rows, walk


def write(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


NAMES = ["a.go", "_b.go", ".c.go", "d/e.go", "_d/e.go", ".d/f/g.go", "d/_x=1/h.go", "_y=2.go", "d/k._COPYING_", "d/sp ace/é.go", "d/.x.txt"]


@pytest.mark.parametrize("limit", [1, 3, 20_000])
def test_walk_lists_every_file_in_any_number_of_rounds(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(walk, "ENTRIES_PER_TASK", limit)
    for i, name in enumerate(NAMES):
        write(tmp_path, name, "x" * i)
    os.symlink(tmp_path / "d", tmp_path / "link")
    got = {r.path: r for r in walk.walk(spark, str(tmp_path)).collect()}
    assert set(got) == {*NAMES, *(n.replace("d/", "link/", 1) for n in NAMES if n.startswith("d/"))}
    assert [got[n].length for n in NAMES] == list(range(len(NAMES)))
    assert {n for n in NAMES if got[n].hidden} == {"_b.go", ".c.go", "_d/e.go", ".d/f/g.go", "d/k._COPYING_", "d/.x.txt"}
    assert {r.status for r in got.values()} == {walk.LISTED}
    assert walk.walk(spark, str(tmp_path / "none")).collect() == []


def test_each_file_is_scanned_once_whatever_its_name(spark, tmp_path):
    for name in NAMES:
        write(tmp_path, name, name)
    got = [(r.path, r.content) for r in files.scan_code(spark, str(tmp_path), "s").collect()]
    assert sorted(got) == sorted((n, n) for n in NAMES if n.endswith(".go"))


def test_hidden_contents_do_not_pass_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_visible_copies", None)
    monkeypatch.setattr(files, "hidden_entries", None)
    monkeypatch.setattr(walk, "BYTES_HELD", 10)
    for i in range(40):
        write(tmp_path, f"_h/{i}.go", f"text {i}")
    scanned = files.scan_code(spark, str(tmp_path), "s")
    assert {r.content for r in scanned.collect()} == {f"text {i}" for i in range(40)}
    assert "Python" not in scanned._jdf.queryExecution().executedPlan().toString()


def test_without_an_arrow_file_system_hidden_names_are_still_scanned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(walk, "can_open", lambda path: False)
    for name in ("_d/a.go", "_b.go", "c.go"):
        write(tmp_path, name, name)
    assert {r.path for r in files.scan_code(spark, str(tmp_path), "s").collect()} == {"_d/a.go", "_b.go", "c.go"}


def test_arrow_paths():
    assert walk.arrow_path("/a/b") == walk.arrow_path("file:/a/b/") == walk.arrow_path("file:///a/b") == ("", "/a/b")
    assert walk.arrow_path("s3a://bucket/x/y") == ("s3://bucket", "bucket/x/y")
    assert walk.arrow_path("hdfs://host:80/x") == ("hdfs://host:80/", "/x")
    assert not walk.can_open("viewfs://store/x") and walk.can_open("/x")


def test_faults_are_counted(spark, tmp_path):
    code = tmp_path / "code"
    write(code, "ok.go", "package a\n\nfunc F() {\n\tf()\n}\n")
    write(code, "bad.go", b"package a\n\n// \xff\nfunc G() {\n\tg()\n}\n")
    write(code, "_open.go", "package a\n\nfunc Lost() {\n\tif x {\n\nfunc H() {\n\th()\n}\n\nfunc Also(\n")
    write(code, "large.go", "// long\n" * 100)
    write(code, "x/.vendor/larger.go", "// long\n" * 200)
    write(code, "large.png", "x" * 9_000)  # not of a kind that is read
    config = CorpusConfig(sources=(SourceConfig("code", str(code)),), max_file_bytes=500)
    expected = {
        "code_files": 3, "undecodable_files": 1, "unbalanced_files": 1, "unclosed_declarations": 2,
        "oversized_files": 2, "unreadable_files": 0, "unreadable_folders": 0,
    }
    accounts = Accounts()
    result = corpus.run_corpus(spark, config, str(tmp_path / "out"), accounts=accounts)
    assert result["written"]["units"] == 3 and accounts.totals() == expected
    accounts = Accounts()
    units, _ = corpus.run_stats(spark, config, accounts)
    assert [r.units for r in units.collect()] == [3] and accounts.totals() == expected


def test_files_that_are_gone_are_counted(spark, tmp_path, monkeypatch):
    """Files that vanish between listing and reading, under names of both sorts."""
    for name in ("a.go", "_b.go", "c.go", "_d.go"):
        write(tmp_path, f"code/{name}", "package a\n\nfunc F() {\n\tf()\n}\n")
    listed = walk.walk(spark, str(tmp_path / "code"))
    monkeypatch.setattr(walk, "walk", lambda *_: listed)
    for name in ("c.go", "_d.go"):
        os.remove(tmp_path / "code" / name)
    accounts = Accounts()
    units, _ = corpus.run_stats(spark, CorpusConfig(sources=(SourceConfig("code", str(tmp_path / "code")),)), accounts)
    assert [r.units for r in units.collect()] == [2]
    assert accounts.totals()["unreadable_files"] == 2 and accounts.totals()["code_files"] == 2
    read = walk.read_listed(spark, str(tmp_path / "code"), listed, 1_000).collect()
    assert {(r.path, r.status) for r in read} == {
        ("a.go", walk.READ), ("_b.go", walk.READ), ("c.go", walk.UNREADABLE), ("_d.go", walk.UNREADABLE)
    }
    assert {r.status for r in walk.read_listed(spark, str(tmp_path / "code"), listed, 3).collect()} == {walk.OVERSIZED}


def names_of(path):
    return {n for n in os.listdir(path) if not n.startswith(".")}


def test_outputs_are_replaced_together(spark, tmp_path):
    out = str(tmp_path / "out")
    with commits.replacing(spark, out) as fresh:
        spark.range(3).write.json(f"{fresh}/a")
        spark.range(5).write.json(f"{fresh}/b")
    with commits.replacing(spark, out) as fresh:
        spark.range(4).write.json(f"{fresh}/a")
        assert spark.read.json(f"{out}/a").count() == 3  # until all is written
    assert (spark.read.json(f"{out}/a").count(), spark.read.json(f"{out}/b").count()) == (4, 5)
    assert names_of(out) == {"a", "b"}


def test_a_failed_run_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    with commits.replacing(spark, out) as fresh:
        spark.range(3).write.json(f"{fresh}/a")
    with pytest.raises(ValueError):
        with commits.replacing(spark, out) as fresh:
            spark.range(9).write.json(f"{fresh}/a")
            raise ValueError
    assert spark.read.json(f"{out}/a").count() == 3 and names_of(out) == {"a"}


def test_an_interrupted_swap_is_finished(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with commits.replacing(spark, out) as fresh:
        for part in "ab":
            spark.range(1).write.json(f"{fresh}/{part}")
    move, moved = commits.Folder.move, []

    def once(self, source, target):
        if moved:
            raise KeyboardInterrupt
        moved.append(target)
        move(self, source, target)

    monkeypatch.setattr(commits.Folder, "move", once)
    with pytest.raises(KeyboardInterrupt):
        with commits.replacing(spark, out) as fresh:
            for part in "ab":
                spark.range(2).write.json(f"{fresh}/{part}")
    monkeypatch.undo()
    commits.settle(spark, out)
    assert [spark.read.json(f"{out}/{part}").count() for part in "ab"] == [2, 2] and names_of(out) == {"a", "b"}
    commits.settle(spark, out)
    commits.settle(spark, str(tmp_path / "never"))


def test_jobs_run_twice_into_one_folder(spark, tmp_path):
    for n in (40, 25):
        write(tmp_path, "own.jsonl", "\n".join(json.dumps({"code": f"func f() {{ {'y' * (40 + i)} }}"}) for i in range(n)))
        config = CorpusConfig(datasets=(DatasetConfig("own", str(tmp_path / "own.jsonl")),), output=str(tmp_path / "out"))
        corpus.run_corpus(spark, config)
        views = corpus.run_training_views(spark, str(tmp_path / "out"), str(tmp_path / "views"))
        assert sum(views.values()) == n == spark.read.json(str(tmp_path / "views/text")).count()
    assert names_of(tmp_path / "out") == {"examples", "units"} and names_of(tmp_path / "views") == {"messages", "text"}


# ---- datasets ----


def pair(root, name, n, **more):
    write(root, name, "\n".join(json.dumps({"question": f"{name} q{i}", "answer": "a", **more}) for i in range(n)))


def origins(made):
    out = {}
    for df in made:
        for r in df.collect():
            out[r.origin] = out.get(r.origin, 0) + 1
    return out


def test_datasets_of_one_kind_are_one_scan(spark, tmp_path):
    datasets = []
    for i in range(12):
        pair(tmp_path, f"d {i}/part.json", 10 + i)
        datasets.append(DatasetConfig(f"n{i}", str(tmp_path / f"d {i}"), "table", "qa", "json", max_samples=(0, 5, 100)[i % 3]))
    config = CorpusConfig()
    made = corpus.all_dataset_examples(spark, tuple(datasets), config)
    assert len(made) == 1
    assert origins(made) == {f"n{i}": 5 if i % 3 == 1 else 10 + i for i in range(12)}
    # A dataset's rows don't depend on which others are read with it.
    rows_of = lambda df: {(r.example_id, r.conversations[2].value) for r in df.collect()}
    alone = set().union(*(rows_of(corpus.dataset_examples(spark, d, config)) for d in datasets))
    assert alone == rows_of(made[0])


def test_filters_have_a_value_for_each_dataset(spark, tmp_path):
    for name in "abc":
        pair(tmp_path, f"{name}/1.json", 4, lang="go")
        pair(tmp_path, f"{name}/2.json", 3, lang="rs")
        pair(tmp_path, f"{name}/3.json", 2)
    made = [
        DatasetConfig(name, str(tmp_path / name), "table", "qa", "json", filter_field="lang", filter_value=value, max_samples=cap)
        for name, value, cap in (("a", "go", 0), ("b", "rs", 2), ("c", None, 0))
    ]
    assert origins(corpus.all_dataset_examples(spark, tuple(made), CorpusConfig())) == {"a": 4, "b": 2, "c": 2}


def test_datasets_that_share_files_are_read_apart(spark, tmp_path):
    pair(tmp_path, "x/1.json", 3)
    pair(tmp_path, "x/y/2.json", 4)
    whole = DatasetConfig("whole", str(tmp_path / "x/1.json"), "table", "qa", "json")
    again = replace(whole, name="again")
    part = replace(whole, name="part", path=str(tmp_path / "x/y"))
    gone = replace(whole, name="gone", path=str(tmp_path / "z"))
    odd = replace(whole, name="odd", type="graph")
    assert origins(corpus.all_dataset_examples(spark, (whole, again, part, gone, odd), CorpusConfig())) == {"whole": 3, "again": 3, "part": 4}
    assert corpus.dataset_examples(spark, gone, CorpusConfig()) is None and corpus.dataset_examples(spark, odd, CorpusConfig()) is None


def test_subsets_and_splits_are_folders(spark, tmp_path):
    for folder, n in (("go/train", 3), ("go/test", 4), ("subset=rs/split=train", 5)):
        pair(tmp_path, f"hub/{folder}/1.json", n)
    pair(tmp_path, "flat/1.json", 6)
    hub = DatasetConfig("hub", str(tmp_path / "hub"), "table", "qa", "json", subset="go")
    count = lambda d: sum(origins(corpus.all_dataset_examples(spark, (d,), CorpusConfig())).values())
    assert count(hub) == 3 and count(replace(hub, split="test")) == 4 and count(replace(hub, subset="rs")) == 5
    assert count(replace(hub, split="none")) == 0 and count(replace(hub, path=str(tmp_path / "flat"), subset=None)) == 6
    # Only the split's folder is listed, so nothing else is read.
    table = rows.read_kind(spark, rows.kinds(spark, [replace(hub, split="test")])[0])
    assert all("go/test" in f for f in table.inputFiles())
    raw = {"golang_datasets": [{"name": "h", "type": "huggingface", "subset": "go", "split": "test"}]}
    assert CorpusConfig.from_dict(raw).datasets[0].split == "test"


def test_an_unreadable_dataset_gives_no_rows(spark, tmp_path):
    write(tmp_path, "broken/1.parquet", b"no parquet")
    write(tmp_path, "empty/readme.txt", "")
    os.remove(tmp_path / "empty/readme.txt")
    broken = DatasetConfig("b", str(tmp_path / "broken"), "table", "qa", filter_field="lang", filter_value="go")
    assert corpus.all_dataset_examples(spark, (broken,), CorpusConfig()) == []
    empty = DatasetConfig("e", str(tmp_path / "empty"), "table", "qa", "json")
    assert origins(corpus.all_dataset_examples(spark, (empty,), CorpusConfig())) == {}


# ---- landed tables, settings, modules ----


def test_landed_contents_are_decoded_like_files(spark, tmp_path):
    code = b"package d\r\n\r\n// Caf\xe9.\rfunc A() {\r\n\ta()\r\n}\r\n"
    write(tmp_path, "tree/a.go", code)
    from_folder = files.scan_code(spark, str(tmp_path / "tree"), "s").first().content
    for name, schema in (("bytes", "source string, path string, content binary"), ("text", files.FILE_SCHEMA)):
        content = code if name == "bytes" else code.decode("utf-8", "replace")
        spark.createDataFrame([("s", "a.go", content)], schema).write.parquet(str(tmp_path / name))
        config = CorpusConfig(sources=(SourceConfig("s", ""),), landed_files=str(tmp_path / name))
        assert corpus.landed_table(spark, config.landed_files).first().content == from_folder
        unit = corpus.read_sources(spark, config)[0].first()
        assert unit.body == "a()" and unit.code.endswith("func A() {\n\ta()\n}")


def test_settings_name_landed_tables_and_outputs(tmp_path):
    raw = {"data": {"landed_files": "files", "output_dir": "./out", "sample_all": True, "skip_patterns_at_root": True, "max_file_bytes": 7}}
    config = CorpusConfig.from_dict(raw, "/conf")
    assert (config.landed_files, config.output, config.sample_all, config.skip_patterns_at_root, config.max_file_bytes) == (
        "/conf/files", "/conf/out", True, True, 7
    )
    assert CorpusConfig.from_yaml(str(tmp_path / "none.yaml")) == CorpusConfig()
    assert CorpusConfig.from_dict(None) == CorpusConfig()


def test_many_manifests_move_no_contents(spark, monkeypatch):
    code = spark.createDataFrame(
        [("s", p, "package x\n\nfunc F() {\n\tf()\n}\n") for p in ("a/b/c.go", "a/x.go", "y.go", "q/r/s.go")] + [("t", "a/x.go", "package x\n\ntype T int\n")],
        files.FILE_SCHEMA,
    )
    manifests = spark.createDataFrame([("s", "a", "ma"), ("s", "q/r", "mq"), ("s", "", "top")], "source string, dir string, module string")
    few = {tuple(r) for r in corpus.units_from_files(code, manifests, CorpusConfig()).collect()}
    monkeypatch.setattr(modules, "MOST_MAPPED", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        units = corpus.units_from_files(code, manifests, CorpusConfig())
        assert {tuple(r) for r in units.collect()} == few
        plan = units._jdf.queryExecution().optimizedPlan()
        joins = [line for line in plan.toString().split("\n") if "Join" in line]
        assert joins
        # What a join's sides hand on: never a file's content, lines or masked text.
        shuffled = units._jdf.queryExecution().sparkPlan().toString()
        below = shuffled[shuffled.index("SortMergeJoin") :].split("\n")[1]
        assert "content" not in below and "masked" not in below and "lines" not in below
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r[4]: r[3] for r in few if r[5] == "s"} == {"a/b/c.go": "ma/b", "a/x.go": "ma", "y.go": "top", "q/r/s.go": "mq"}


def test_listed_trees_are_read_by_tasks_alone(spark, tmp_path, monkeypatch):
    """Scans that share a listing read all names by tasks, leave the same files out, and give the
    rows of a scan by itself; modules are looked up without a read of contents."""
    for name in NAMES:
        write(tmp_path, f"code/{name}", f"package p\n\nfunc F() {{\n\tf()\n}}\n// {name}\n")
    write(tmp_path, "code/go.mod", "module example.org/top\n")
    write(tmp_path, "code/d/go.mod", "module example.org/inner\n")
    write(tmp_path, "code/large.go", "// large\n" * 100)
    write(tmp_path, "code/bad.go", b"package p\n// \xff\n")
    for i in range(40):
        write(tmp_path, f"docs/{i}.md", f"## Title {i}\n\n" + "text that is long enough " * 9)
    code = str(tmp_path / "code")
    listed = walk.walk(spark, files.qualified(spark, code))
    alone = files.scan_code(spark, code, "s", most_bytes=500, sound=True)
    shared = files.scan_code(spark, code, "s", listed=listed, most_bytes=500, sound=True)
    assert sorted(map(tuple, shared.collect())) == sorted(map(tuple, alone.collect()))
    assert "large.go" not in {r.path for r in shared.collect()}
    named = files.listed_paths(listed, "s", files.CODE, 500)
    assert sorted(r.path for r in named.collect()) == sorted(r.path for r in shared.collect())
    sources = (SourceConfig("code", code), SourceConfig("docs", str(tmp_path / "docs"), "spec"))
    config = CorpusConfig(sources=sources, max_file_bytes=500)
    made = []
    for most in (20_000, 0):
        monkeypatch.setattr(modules, "MOST_MAPPED", most)
        units, found = corpus.read_sources(spark, config)
        for table in (units, found):
            assert "binaryFile" not in table._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 40
        made.append(sorted((r.file_path, r.name, r.module_path) for r in units.collect()))
    assert made[0] == made[1] and {m for _, _, m in made[0]} >= {"example.org/top", "example.org/inner"}
