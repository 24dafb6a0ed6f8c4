"""Registered queries. Each reads whole tables and composes library operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.config import CorpusConfig, DatasetConfig, SourceConfig
from corpusflow.functions import chat, hashing
from corpusflow.functions import text as tx
from corpusflow.operators import (
    chat_views,
    code_units,
    examples,
    filters,
    logs,
    modules,
    normalize,
    packages,
    sampling,
    sections,
    stats,
    turns,
)
from corpusflow.operators.accounts import Accounts
from corpusflow.plans import corpus, rendered
from corpusflow.sources import catalog, files, rows, sinks
from corpusflow.sources.scratch import scratch_dir, stage
from corpusflow.streaming import jobs

# Settings of all queries. The path globs and weights of the standard settings.
CONFIG = CorpusConfig(
    include_tests=False,
    skip_patterns=(
        "**/vendor/**", "**/testdata/**", "**/testutil/**", "**/*_generated.go",
        "**/*_generated_*.go", "**/zz_generated*", "**/mock_*.go", "**/fake_*.go",
        "**/*_fake.go", "**/*.pb.go",
    ),
    weights={
        "code_explanation": 1.0,
        "code_completion": 0.85,
        "type_documentation": 0.95,
        "package_overview": 0.6,
        "spec_explanation": 0.9,
    },
    sources=tuple(
        SourceConfig(name=f"src{i}", path="", type="spec", domain=f"Handbook src{i}" if i % 2 else None)
        for i in range(20)
    ),
)
KEEP_WEIGHT = 0.3
CAP_PER_SOURCE = 20
CAP_TOTAL = 300
CAP_DATASET = 120
CAP_PAIRS = 25
PREFIX_ROWS = 150
CHUNK = 100_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def _bigint(df: DataFrame) -> DataFrame:
    """All integer columns as bigint, the one integer type both engines agree on."""
    small = {"int", "smallint", "tinyint"}
    return df.select(*[F.col(c).cast("bigint").alias(c) if t in small else F.col(c) for c, t in df.dtypes])


def _question_answer(made: DataFrame) -> DataFrame:
    said = F.col("conversations")
    return made.select(
        "example_id", said[1]["value"].alias("question"), said[2]["value"].alias("answer")
    )


def _turn_rows(df: DataFrame, column: str) -> DataFrame:
    first, second = ("from", "value") if column == "conversations" else ("role", "content")
    return _bigint(
        df.select("example_id", F.posexplode(column).alias("turn", "t")).select(
            "example_id", "turn", F.col("t")[first].alias("role"), F.col("t")[second].alias("value")
        )
    )


# ---- chats ----


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = rendered.table(spark, sf_dir, "conversations")
    nested = normalize.nest_turns(landed, "conv_id", "turn", "role", "text")
    return normalize.normalize(nested, "messages", CONFIG, "chats", F.col("conv_id"))


def _chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_in = rendered.table(spark, sf_dir, "conversations")
    return turns.normalize_turns(rows_in, "conv_id", "turn", "role", "text", CONFIG, "chats")


@query
def chat_normalize(spark, sf_dir):
    return _chat_turns(spark, sf_dir).withColumnRenamed("from", "role")


@query
def chat_render(spark, sf_dir):
    return chat_views.render_text(_chats(spark, sf_dir)).select("example_id", "text")


@query
def chat_messages(spark, sf_dir):
    return turns.message_turns(_chat_turns(spark, sf_dir)).withColumnRenamed("content", "value")


@query
def chat_prompt(spark, sf_dir):
    asked = rendered.table(spark, sf_dir, "conversations").filter("role = 'user'")
    return chat_views.render_prompts(asked, "text", CONFIG).select("conv_id", "turn", "prompt")


@query
def response_spans(spark, sf_dir):
    return turns.response_spans(_chat_turns(spark, sf_dir))


@query
def length_profile(spark, sf_dir):
    return turns.length_profile(_chat_turns(spark, sf_dir), CONFIG)


@query
def nested_messages(spark, sf_dir):
    """The same views on chats that are one row each, without a shuffle of their own."""
    return _turn_rows(chat_views.to_messages(_chats(spark, sf_dir)), "messages")


@query
def nested_response_spans(spark, sf_dir):
    return _bigint(chat_views.response_spans(_chats(spark, sf_dir)))


@query
def nested_length_profile(spark, sf_dir):
    return _bigint(chat_views.length_profile(_chats(spark, sf_dir), CONFIG))


@query
def message_filter(spark, sf_dir):
    """Turns that stay and turns dropped for a null field, where enough turns stay."""
    counted = turns.turn_counts(rendered.gapped_turns(spark, sf_dir), "conv_id", "role", "text")
    return counted.filter(F.col("kept") >= 2).select(
        F.concat(F.lit("gapped|"), F.col("conv_id").cast("string")).alias("example_id"),
        (F.col("kept") + 1).alias("turns"),
        F.col("null_turns").alias("null_messages"),
    )


@query
def nested_message_filter(spark, sf_dir):
    nested = normalize.nest_turns(
        rendered.gapped_turns(spark, sf_dir), "conv_id", "turn", "role", "text"
    ).withColumn("null_messages", normalize.dropped_messages(F.col("messages")))
    made = normalize.with_chats(nested, "messages", CONFIG).filter(F.col("conversations").isNotNull())
    return _bigint(
        made.select(
            F.concat(F.lit("gapped|"), F.col("conv_id").cast("string")).alias("example_id"),
            F.size("conversations").alias("turns"),
            "null_messages",
        )
    )


# ---- dataset rows ----


@query
def qa_pairs(spark, sf_dir):
    made = rendered.pair_rows(spark, sf_dir, "qa")
    return _question_answer(normalize.normalize(made, "qa", CONFIG, "qa", F.col("row_key")))


@query
def instruction_pairs(spark, sf_dir):
    made = rendered.pair_rows(spark, sf_dir, "instruction")
    return _question_answer(
        normalize.normalize(made, "instruction", CONFIG, "instruction", F.col("row_key"))
    )


@query
def code_pairs(spark, sf_dir):
    made = rendered.code_rows(spark, sf_dir)
    return _question_answer(normalize.normalize(made, "code", CONFIG, "pairs", F.col("row_key")))


def _land_jsonl(spark: SparkSession, sf_dir: str) -> str:
    """Chat rows and code rows in one folder of JSON lines."""
    path = scratch_dir(spark, "jsonl")
    _chats(spark, sf_dir).select("conversations").write.json(path)
    code = rendered.code_rows(spark, sf_dir)
    code.select(*schemas.JSONL_CODE_KEYS, *schemas.JSONL_DOC_KEYS).write.mode("append").json(path)
    return path


def _ends(made: DataFrame) -> DataFrame:
    said = F.col("conversations")
    return _bigint(
        made.select(
            "origin",
            F.size(said).alias("turns"),
            said[0]["value"].alias("first"),
            F.element_at(said, -1)["value"].alias("last"),
        )
    )


@query
def jsonl_dataset(spark, sf_dir):
    """Those rows read back as a dataset."""
    dataset = DatasetConfig(name="landed", path=_land_jsonl(spark, sf_dir))
    return _ends(corpus.dataset_examples(spark, dataset, CONFIG))


@query
def table_dataset(spark, sf_dir):
    """A landed table with a row filter, normalised, without a cap."""
    path = scratch_dir(spark, "landed")
    made = rendered.pair_rows(spark, sf_dir, "qa")
    made.withColumn("lang", F.when(F.col("row_key").endswith("2"), F.lit("go"))).write.json(path)
    dataset = DatasetConfig(
        name="landed", path=path, type="table", format="qa", file_format="json",
        filter_field="lang", filter_value="go",
    )
    return _question_answer(corpus.dataset_examples(spark, dataset, CONFIG)).drop("example_id")


def _landed_pairs(spark: SparkSession, sf_dir: str, cap: int = 0) -> DataFrame:
    """Turn pairs landed as JSON lines, some of them twice, read as a dataset."""
    path = scratch_dir(spark, "pairs")
    made = rendered.pair_rows(spark, sf_dir, "qa")
    copies = F.explode(F.when(F.col("row_key").endswith("1"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    made.select("*", copies.alias("copy")).drop("row_key", "copy").write.option("maxRecordsPerFile", 1000).json(path)
    dataset = DatasetConfig(name="landed", path=path, type="table", format="qa", file_format="json", max_samples=cap)
    return corpus.dataset_examples(spark, dataset, CONFIG)


@query
def dataset_cap(spark, sf_dir):
    """A dataset cap by row content, counting repeated rows one by one."""
    return _landed_pairs(spark, sf_dir, CAP_DATASET).groupBy("example_id").agg(F.count("*").alias("rows"))


@query
def dataset_split(spark, sf_dir):
    """The holdout split of a landed dataset with repeated rows."""
    staged = stage(_landed_pairs(spark, sf_dir).select("example_id"), "examples")
    split = sampling.holdout(staged, "example_id", CONFIG.seed)
    return split.groupBy("example_id", "split").agg(F.count("*").alias("rows"))


@query
def field_filter(spark, sf_dir):
    """Documents whose label says quality 1; unlabelled documents never match."""
    documents = rendered.table(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = documents.join(rendered.table(spark, sf_dir, "labels"), "doc_id", "left")
    english = filters.field_equals(labelled, "lang", "en")
    return filters.field_equals(english, "quality", 1).select("doc_id", "lang")


# ---- Markdown ----


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.extract_sections(rendered.markdown(spark, sf_dir))


@query
def md_sections(spark, sf_dir):
    return _bigint(_sections(spark, sf_dir))


@query
def md_section_stats(spark, sf_dir):
    return stats.section_stats(_sections(spark, sf_dir))


@query
def section_examples(spark, sf_dir):
    return _question_answer(examples.section_examples(_sections(spark, sf_dir), CONFIG))


# ---- code ----


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = modules.read_manifests(rendered.manifests(spark, sf_dir))
    return corpus.units_from_files(rendered.source_tree(spark, sf_dir), found, CONFIG)


def _unit_examples(spark: SparkSession, sf_dir: str, example_type: str) -> DataFrame:
    return _question_answer(examples.unit_examples(_units(spark, sf_dir), CONFIG, only=(example_type,)))


@query
def code_files(spark, sf_dir):
    return code_units.select_files(rendered.source_tree(spark, sf_dir), CONFIG).select("source", "path")


@query
def code_units_all(spark, sf_dir):
    return _bigint(_units(spark, sf_dir))


@query
def code_unit_stats(spark, sf_dir):
    return stats.code_stats(_units(spark, sf_dir))


@query
def explain_code(spark, sf_dir):
    return _unit_examples(spark, sf_dir, "code_explanation")


@query
def complete_code(spark, sf_dir):
    return _unit_examples(spark, sf_dir, "code_completion")


@query
def document_type(spark, sf_dir):
    return _unit_examples(spark, sf_dir, "type_documentation")


@query
def package_overview(spark, sf_dir):
    # Two branches read the units; staging the narrow columns keeps it at one extraction.
    units = stage(_units(spark, sf_dir).select(*examples.COUNTED), "units")
    return _question_answer(packages.package_examples(units, CONFIG))


@query
def wide_packages(spark, sf_dir):
    """Packages with more files and names than an overview lists, some with a documented init."""
    return _question_answer(packages.package_examples(rendered.package_units(spark, sf_dir), CONFIG))


# ---- paths, sources ----


@query
def module_lookup(spark, sf_dir):
    placed = modules.attach_modules(
        rendered.page_files(spark, sf_dir), rendered.page_manifests(spark, sf_dir)
    )
    return placed.select("page_id", "module_path")


@query
def source_attributes(spark, sf_dir):
    listed = catalog.source_table(spark, CONFIG.sources)
    documents = rendered.table(spark, sf_dir, "documents").select("doc_id", "source")
    return catalog.attach_source(documents, listed)


@query
def path_filters(spark, sf_dir):
    path = F.col("path")
    return rendered.odd_paths(spark, sf_dir).select(
        "page_id",
        "path",
        filters.is_code_path(path, CONFIG.include_tests, CONFIG.skip_patterns).alias("is_code"),
        filters.is_code_path(path, True, CONFIG.skip_patterns, patterns_at_root=True).alias("is_code_at_root"),
        filters.is_markdown_path(path).alias("is_markdown"),
    )


# ---- sampling, order, split ----


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.table(spark, sf_dir, "documents").select("doc_id", "source")


@query
def weighted_keep(spark, sf_dir):
    keep = hashing.keep_share(F.col("doc_id"), CONFIG.seed, "keep", KEEP_WEIGHT)
    return _documents(spark, sf_dir).filter(keep)


@query
def template_choice(spark, sf_dir):
    wording = hashing.pick(F.col("doc_id"), CONFIG.seed, "wording", list(CONFIG.wording.sections))
    return _documents(spark, sf_dir).select("doc_id", wording.alias("wording"))


@query
def cap_per_source(spark, sf_dir):
    return sampling.cap_per_group(_documents(spark, sf_dir), "source", "doc_id", CAP_PER_SOURCE, CONFIG.seed)


@query
def cap_total(spark, sf_dir):
    return sampling.cap(_documents(spark, sf_dir), "doc_id", CAP_TOTAL, CONFIG.seed)


@query
def prefix_cap(spark, sf_dir):
    return sampling.first_rows(_documents(spark, sf_dir), PREFIX_ROWS, "doc_id")


@query
def holdout_split(spark, sf_dir):
    return sampling.holdout(_documents(spark, sf_dir), "doc_id", CONFIG.seed)


@query
def seeded_order(spark, sf_dir):
    return sampling.with_position(_documents(spark, sf_dir), "doc_id", CONFIG.seed)


# ---- whole corpus ----


def _all_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of all origins from one extraction of the units."""
    units = stage(_units(spark, sf_dir), "units")
    made = corpus.build_examples(units, _sections(spark, sf_dir), CONFIG)
    pairs = rendered.pair_rows(spark, sf_dir, "qa")
    return (
        made.unionByName(_chats(spark, sf_dir))
        .unionByName(normalize.normalize(pairs, "qa", CONFIG, "qa", F.col("row_key")))
    )


@query
def origin_totals(spark, sf_dir):
    """Counts only: units by the lengths of their texts, chats as turn rows."""
    made = corpus.example_counts(_units(spark, sf_dir), _sections(spark, sf_dir), CONFIG)
    chats = _chat_turns(spark, sf_dir).filter("turn = 0").select(F.lit("chats").alias("origin"))
    pairs = rendered.pair_rows(spark, sf_dir, "qa")
    qa = normalize.normalize(pairs, "qa", CONFIG, "qa", F.col("row_key")).select("origin")
    return stats.totals(made.select("origin").unionByName(chats).unionByName(qa), "origin", "examples")


@query
def corpus_build(spark, sf_dir):
    """All examples, staged, split, rendered."""
    staged = stage(_all_examples(spark, sf_dir), "examples")
    split = sampling.holdout(staged, "example_id", CONFIG.seed)
    return chat_views.render_text(split).select("example_id", "origin", "example_type", "split", "text")


@query
def corpus_job(spark, sf_dir):
    """The whole job over a landed table of files and a landed dataset; its files read back."""
    root = scratch_dir(spark, "job")
    code = rendered.source_tree(spark, sf_dir).select("source", "path", "content")
    manifest = rendered.manifests(spark, sf_dir).select("source", "path", "content")
    text = rendered.markdown(spark, sf_dir).select("source", "path", "content")
    code.unionByName(manifest).unionByName(text).write.parquet(f"{root}/files", compression="zstd")
    rendered.pair_rows(spark, sf_dir, "qa").drop("row_key").write.json(f"{root}/pairs")
    names = rendered.table(spark, sf_dir, "part").select("p_type").distinct().collect()
    listed = tuple(SourceConfig(name=r["p_type"], path="") for r in names)
    specs = tuple(SourceConfig(f"src{i}", "", "spec", f"Handbook src{i}") for i in range(20))
    pairs = DatasetConfig("qa", f"{root}/pairs", "table", "qa", "json")
    config = replace(CONFIG, sources=listed + specs, datasets=(pairs,), landed_files=f"{root}/files", output_compression="gzip")
    corpus.run_corpus(spark, config, f"{root}/out", ordered=False)
    corpus.run_training_views(spark, f"{root}/out", f"{root}/views", "gzip")
    return spark.read.schema("text string").json(f"{root}/views/text").select("text")


def _landed_job(spark: SparkSession, sf_dir: str, root: str) -> CorpusConfig:
    """Files with foreign newlines, chats and four datasets, landed; the settings that read them."""
    code = rendered.source_tree(spark, sf_dir).select("source", "path", "content")
    folded = code.withColumn("content", F.replace("content", F.lit("\n"), F.lit("\r\n")))
    manifest = rendered.manifests(spark, sf_dir).select("source", "path", "content")
    text = rendered.markdown(spark, sf_dir).select("source", "path", "content")
    folded.unionByName(manifest).unionByName(text).write.parquet(f"{root}/files", compression="zstd")
    pair_rows = rendered.pair_rows(spark, sf_dir, "qa").withColumn("last", F.substring("row_key", -1, 1))
    language = F.when(F.col("last").isin("0", "4"), F.lit("go")).when(F.col("last") == "2", F.lit("rs"))
    for name in ("capped", "other", "plain"):
        chosen = pair_rows.filter(F.col("last") == "6") if name == "plain" else pair_rows.withColumn("lang", language)
        chosen.drop("row_key", "last").write.json(f"{root}/{name}")
    turns_in = rendered.table(spark, sf_dir, "conversations")
    normalize.nest_turns(turns_in, "conv_id", "turn", "role", "text").select("messages").write.json(f"{root}/chats")
    datasets = (
        DatasetConfig("capped", f"{root}/capped", "table", "qa", "json", CAP_PAIRS, filter_field="lang", filter_value="go"),
        DatasetConfig("other", f"{root}/other", "table", "qa", "json", filter_field="lang", filter_value="rs"),
        DatasetConfig("plain", f"{root}/plain", "table", "qa", "json"),
        DatasetConfig("odd", f"{root}/plain", "graph"),
        DatasetConfig("chats", f"{root}/chats", "table", "messages", "json"),
    )
    names = rendered.table(spark, sf_dir, "part").select("p_type").distinct().collect()
    listed = tuple(SourceConfig(name=r["p_type"], path="") for r in names)
    specs = tuple(SourceConfig(f"src{i}", "", "spec", f"Handbook src{i}") for i in range(20))
    return replace(CONFIG, sources=listed + specs, datasets=datasets, landed_files=f"{root}/files", output_compression="gzip")


@query
def corpus_datasets(spark, sf_dir):
    """The whole job in its default order with datasets of all kinds: capped and filtered, filtered,
    plain, unknown, chats. It runs twice into one folder; the second run replaces the first."""
    root = scratch_dir(spark, "job")
    config = _landed_job(spark, sf_dir, root)
    corpus.run_corpus(spark, replace(config, sources=()), f"{root}/out", ordered=False)
    corpus.run_corpus(spark, config, f"{root}/out")
    corpus.run_training_views(spark, f"{root}/out", f"{root}/views", "gzip")
    return spark.read.schema("text string").json(f"{root}/views/text").select("text")


@query
def corpus_counts(spark, sf_dir):
    """What the job says it made: examples per origin, rows written, and files that looked odd."""
    root = scratch_dir(spark, "job")
    accounts = Accounts()
    made = corpus.run_corpus(spark, _landed_job(spark, sf_dir, root), f"{root}/out", ordered=False, accounts=accounts)
    rows_out = [(part, name, n) for part, counts in {**made, "files": accounts.totals()}.items() for name, n in counts.items()]
    return spark.createDataFrame(rows_out, "part string, name string, rows bigint")


@query
def corpus_stats(spark, sf_dir):
    units = stats.code_stats(_units(spark, sf_dir)).select("source", F.col("units").alias("found"))
    found = stats.section_stats(_sections(spark, sf_dir)).select("source", F.col("sections").alias("found"))
    both = units.withColumn("what", F.lit("units")).unionByName(found.withColumn("what", F.lit("sections")))
    return both.groupBy("what").agg(F.count("*").alias("sources"), F.sum("found").alias("found"))


# ---- text helpers ----


@query
def camel_words(spark, sf_dir):
    name = F.concat(
        F.regexp_replace(F.initcap("p_name"), " ", ""), F.when(F.col("p_partkey") % 2 == 0, F.lit("HTTPServer2Go")).otherwise(F.lit("ID"))
    )
    return rendered.table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), tx.camel_words(name).alias("words"))


@query
def strip_text(spark, sf_dir):
    padded = F.concat(F.lit("\u3000\x1c \n\x85"), F.col("text"), F.lit("\t\u2003\x0b"))
    return rendered.table(spark, sf_dir, "documents").select("doc_id", tx.strip(padded).alias("stripped"))


@query
def line_prefix(spark, sf_dir):
    return rendered.table(spark, sf_dir, "documents").select(
        "doc_id", tx.comment_lines(F.col("text")).alias("commented")
    )


@query
def decode_text(spark, sf_dir):
    """Texts as bytes with a bad byte and foreign newlines, decoded tolerantly."""
    newline = F.when(F.col("doc_id") % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\r"))
    raw = F.concat(
        F.encode(F.replace(F.col("text"), F.lit("\n"), newline), "UTF-8"), F.unhex(F.lit("FF41"))
    )
    return rendered.table(spark, sf_dir, "documents").select("doc_id", tx.decode_text(raw).alias("decoded"))


# ---- files ----


@query
def tree_scan(spark, sf_dir):
    """documents written as a folder tree of text files, then scanned like a source tree."""
    root = scratch_dir(spark, "tree")
    written = rendered.table(spark, sf_dir, "documents").select("source", "text")
    written.write.partitionBy("source").option("maxRecordsPerFile", 500).text(root)
    found = files.scan_tree(spark, root, "tree", "*.txt").select(
        tx.dirname(F.col("path")).alias("dir"), F.explode(F.split("content", "\n", -1)).alias("line")
    )
    return found.filter(F.col("line") != "").groupBy("dir", "line").agg(F.count("*").alias("n"))


def _tree_config(spark: SparkSession, sf_dir: str) -> CorpusConfig:
    """The rendered tree written as files, and the settings that read it."""
    root = scratch_dir(spark, "trees")
    rendered.write_files(rendered.odd_tree(spark, sf_dir), f"{root}/code")
    rendered.write_files(rendered.odd_documents(spark, sf_dir), f"{root}/docs")
    names = rendered.table(spark, sf_dir, "part").select("p_type").distinct().collect()
    code = [SourceConfig(r["p_type"], f"{root}/code/{r['p_type']}") for r in names]
    sources = (*code, SourceConfig("handbook", f"{root}/docs", "spec"), SourceConfig("gone", f"{root}/gone"))
    return replace(CONFIG, sources=sources, max_file_bytes=rendered.TREE_FILE_BYTES)


@query
def tree_corpus(spark, sf_dir):
    """Units and sections of written trees with hidden, blank, broken, too large and foreign files."""
    units, found = corpus.read_sources(spark, _tree_config(spark, sf_dir))
    code = units.select(
        F.lit("unit").alias("what"), F.col("project_name").alias("source"), F.col("file_path").alias("path"),
        F.col("module_path").alias("owner"), "kind", "name", F.col("line_number").cast("bigint").alias("place"),
    )
    text = found.select(
        F.lit("section"), "source_name", "file_path", "domain", F.concat(F.lit("h"), "level"), "title", F.col("position").cast("bigint")
    )
    return code.union(text)


@query
def tree_faults(spark, sf_dir):
    """What the statistics job counts in those trees besides units."""
    accounts = Accounts()
    code, _ = corpus.run_stats(spark, _tree_config(spark, sf_dir), accounts)
    stage(code, "stats")
    return spark.createDataFrame(list(accounts.totals().items()), "what string, files bigint")


@query
def split_sink(spark, sf_dir):
    """Split examples written as JSON lines and read back."""
    path = scratch_dir(spark, "split")
    staged = stage(_chats(spark, sf_dir), "examples")
    sinks.write_split(sampling.holdout(staged, "example_id", CONFIG.seed), path)
    parts = []
    for name in ("train", "val"):
        part = rows.read_chats(spark, f"{path}/split={name}")
        parts.append(part.select(F.lit(name).alias("split"), chat.render(F.col("conversations")).alias("text")))
    return parts[0].unionByName(parts[1])


@query
def messages_sink(spark, sf_dir):
    """The same split in role/content form, written and read back."""
    path = scratch_dir(spark, "messages")
    staged = stage(_chats(spark, sf_dir), "examples")
    sinks.write_messages(sampling.holdout(staged, "example_id", CONFIG.seed), path)
    parts = []
    for name in ("train", "valid"):
        part = rows.read_jsonl(spark, f"{path}/split={name}", schemas.MESSAGES)
        last = F.element_at("messages", -1)
        parts.append(
            part.select(
                F.lit(name).alias("split"),
                F.size("messages").cast("bigint").alias("turns"),
                last["role"].alias("last_role"),
                last["content"].alias("last_content"),
            )
        )
    return parts[0].unionByName(parts[1])


@query
def unit_sink(spark, sf_dir):
    """Units written as JSON lines and read back."""
    path = scratch_dir(spark, "units")
    units = _units(spark, sf_dir)
    sinks.write_units(units, path)
    return rows.read_jsonl(spark, path, units.select(*schemas.UNIT_SINK_COLUMNS).schema)


# ---- logs and streams ----


@query
def log_metrics(spark, sf_dir):
    return logs.parse_log(rendered.log_lines(spark, sf_dir))


@query
def log_progress(spark, sf_dir):
    metrics = logs.parse_log(rendered.log_lines(spark, sf_dir))
    return logs.progress(metrics, "run", "line_no", CHUNK).select("run", "line_no", "iteration", "advance")


@query
def stream_log_metrics(spark, sf_dir):
    """Log lines landed as text files, parsed as a stream."""
    root = scratch_dir(spark, "log-stream")
    rendered.log_lines(spark, sf_dir).select("value").write.text(f"{root}/in")
    jobs.run_available(jobs.log_stream(spark, f"{root}/in"), f"{root}/out")
    return spark.read.parquet(f"{root}/out")


@query
def stream_log_progress(spark, sf_dir):
    """Logs landed as one file a run, streamed, numbered by file and line, and compared line by line."""
    root = scratch_dir(spark, "run-logs")
    lines = rendered.log_lines(spark, sf_dir).repartition("run").sortWithinPartitions("run", "line_no")
    lines.select("run", "value").write.partitionBy("run").text(f"{root}/in")
    jobs.run_available(jobs.line_stream(spark, f"{root}/in"), f"{root}/out")
    landed = logs.numbered(spark.read.parquet(f"{root}/out"))
    run = F.regexp_extract("file", r"run=(\d+)", 1).cast("bigint").alias("run")
    metrics = logs.parse_log(landed.select(run, "line", "value"))
    return logs.progress(metrics, "run", "line", CHUNK).select("run", "line", "iteration", "advance")


@query
def stream_jsonl(spark, sf_dir):
    """Chats and code rows landed as JSON lines, normalised as a stream."""
    root = scratch_dir(spark, "jsonl-stream")
    jobs.run_available(jobs.jsonl_stream(spark, _land_jsonl(spark, sf_dir), CONFIG, "landed"), root)
    return _ends(spark.read.parquet(root))


@query
def stream_normalize(spark, sf_dir):
    """Conversations landed as JSON files, normalised as a stream."""
    root = scratch_dir(spark, "chat-stream")
    landed = rendered.table(spark, sf_dir, "conversations")
    nested = normalize.nest_turns(landed, "conv_id", "turn", "role", "text")
    nested.write.json(f"{root}/in")
    stream = jobs.normalize_stream(
        spark, f"{root}/in", nested.schema, "messages", CONFIG, "chats", "conv_id"
    )
    jobs.run_available(stream, f"{root}/out")
    return _turn_rows(spark.read.parquet(f"{root}/out"), "conversations")
