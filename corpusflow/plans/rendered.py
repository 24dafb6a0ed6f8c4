"""Inputs rendered from the test tables: Markdown, source trees, dataset rows, log lines.

The tables hold no code and no Markdown. These views turn their rows into such text, so
that every query reads whole tables and grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources import walk

# Rows of a rendered code file come from at most this many consecutive part keys.
PART_KEYS_PER_FILE = 3000

CODE_HEAD = """// Header of a rendered file.
package {package}

import "fmt"

var sample = `
func Hidden() {
type Fake struct {
`

/* block
func AlsoHidden() { }
*/
"""
GENERATED_LINE = "// Code generated by a tool. DO NOT EDIT.\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as Markdown: each fifth line a level-2 heading, others level 3."""
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.when(i % 5 == 0, F.concat(F.lit("## "), line))
        .when(i % 7 == 3, F.concat(F.lit("### "), line))
        .otherwise(line),
    )
    return table(spark, sf_dir, "documents").select(
        "source",
        F.concat(F.lit("Handbook "), F.col("source")).alias("domain"),
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        F.array_join(lines, "\n").alias("content"),
    )


def _declarations() -> str:
    """SQL for the text of one declaration of a part row, doc comment included."""
    return r"""
    concat(
      case (p_partkey div 5) % 5
        when 1 then concat('// ', name, ' ', p_name, ' {sample\n')
        when 2 then concat('// ', name, '\n//\n// ', p_name, '\n')
        when 3 then concat('// ', name, '\n\n// ', p_name, '\n\n')
        when 4 then '// detached\n\n\n'
        else '' end,
      case p_partkey % 5
        when 0 then concat('func ', name, '(in string, opt struct{}, cb func(n int) error) (int, error) {\n',
          '\ts := "brace { in \\" text"\n\tr := ''{''\n', steps, '\n\treturn ', p_size, ', nil\n}')
        when 1 then concat('func (',
          case (p_partkey div 5) % 3
            when 0 then concat('x *Holder', p_partkey)
            when 1 then concat('x Holder', p_partkey, '[T]')
            else concat('Holder', p_partkey) end,
          ') ', name, '(\n\tctx interface{},\n\tin []byte,\n) error {\n', steps, '\n\treturn nil\n}')
        when 2 then case when p_size % 10 = 0 then concat('type ', name, ' struct{}')
          else concat('type ', name, ' struct {\n\t// note }\n', fields, '\n}') end
        when 3 then concat('type ', name, ' interface {\n', calls, '\n}')
        else concat('type ', name, case when p_size % 2 = 0 then ' map[string]struct{}'
          else ' func(a interface{}) error' end) end)"""


def source_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a source tree (source, path, content); one declaration per part.

    A file takes a bounded range of part keys, so larger tables give more files and never
    larger ones.
    """
    # Rendered text compresses so well that adaptive execution would put all files into one
    # task; a fixed count keeps the rendering and the parsing that follows spread out.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = (
        table(spark, sf_dir, "part")
        .withColumn("brand", F.substring_index("p_brand", "#", -1))
        .withColumn("file_no", F.expr(f"p_partkey div {PART_KEYS_PER_FILE}"))
        .repartition(tasks, "p_type", "brand", "file_no")
        .withColumn(
            "name",
            F.expr(
                "concat(if(p_partkey % 3 = 0, lower(word), word), p_partkey)".replace(
                    "word", "element_at(array('Load', 'Apply', 'Spec', 'Port', 'Code'), cast(p_partkey % 5 as int) + 1)"
                )
            ),
        )
        .withColumn("steps", _repeated("0, 1", r"""'\tvisit(', i, ', "{ ', p_name, ' \\" }", ''}'') // ', i, ' }\n\t/* { */ visit(-', i, ', i)'"""))
        .withColumn("fields", _repeated("2", r"'\tField', i, ' string `json:\"{f', i, '\"`'"))
        .withColumn("calls", _repeated("3", r"'\tCall', i, '(in interface{}) error'"))
    )
    blocks = named.select(
        F.col("p_type").alias("source"), "brand", "file_no", "p_partkey", F.expr(_declarations()).alias("block")
    )
    path = F.expr(
        """concat(case when brand = '24' then 'vendor/' else '' end, 'pkg/brand_', brand, '/part_', file_no,
             case when brand = '23' then '_test' when brand = '22' then '.pb' else '' end, '.go')"""
    )
    head = F.concat(
        F.when(F.col("brand") == "25", F.lit(GENERATED_LINE)).otherwise(F.lit("")),
        F.replace(F.lit(CODE_HEAD), F.lit("{package}"), F.concat(F.lit("brand"), F.col("brand"))),
    )
    return (
        blocks.groupBy("source", "brand", "file_no")
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "block"))).alias("blocks"))
        .select(
            "source",
            path.alias("path"),
            F.concat(
                head, F.lit("\n"), F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n"), F.lit("\n")
            ).alias("content"),
        )
    )


def _repeated(kinds: str, line: str):
    """p_size lines, i counting from 1, for the kinds of declarations that have such lines."""
    return F.expr(f"if(p_partkey % 5 in ({kinds}), array_join(transform(sequence(1, p_size), i -> concat({line})), '\\n'), null)")


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest files of the rendered tree: a root one for most sources, and one for each
    fifth brand. The source PROMO has no root manifest."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("source"), F.substring_index("p_brand", "#", -1).alias("brand")
    )
    nested = parts.distinct().filter(F.col("brand").cast("int") % 5 == 0).select(
        "source",
        F.concat(F.lit("pkg/brand_"), "brand", F.lit("/go.mod")).alias("path"),
        F.concat(F.lit("// nested\nmodule example.org/brand"), "brand", F.lit("\n\ngo 1.22\n")).alias("content"),
    )
    root = parts.select("source").distinct().filter(F.col("source") != "PROMO").select(
        "source",
        F.lit("go.mod").alias("path"),
        F.concat(F.lit("module example.org/"), F.lower("source"), F.lit("\n")).alias("content"),
    )
    return nested.unionByName(root)


#: Planted files of a written tree are larger than this.
TREE_FILE_BYTES = 4_000_000
# A bracket that stays open, a function that never closes, and one that does.
BROKEN_FILE = "package open\n\nvar x = (1\n\nfunc Broken() {\n\tif x {\n\nfunc Kept() {\n\tkept()\n}\n"


def odd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source tree as files (source, path, content as bytes) of all kinds: some in folders or
    under names that begin with '_' or '.', some with other newlines or a bad byte, manifests, and
    in each source a blank file, one with broken brackets and one that is too large."""
    path, code = F.col("path"), F.col("content")
    moved = path
    for here, there in (
        ("pkg/brand_21/", "pkg/_brand_21/"), ("pkg/brand_31/", ".ci/brand_31/"),
        ("brand_41/part", "brand_41/_part"), ("brand_32/part", "brand_32/.part"),
    ):
        moved = F.replace(moved, F.lit(here), F.lit(there))
    folded = F.when(path.contains("brand_51/"), F.replace(code, F.lit("\n"), F.lit("\r\n"))).otherwise(code)
    bad = F.when(path.contains("brand_12/"), F.unhex(F.lit("2F2FFF0A"))).otherwise(F.unhex(F.lit("")))
    made = source_tree(spark, sf_dir).select(
        "source", moved.alias("path"), F.concat(F.encode(folded, "UTF-8"), bad).alias("content")
    )
    planted = F.array(
        F.struct(F.lit("pkg/blank.go").alias("path"), F.lit(" \n\t\n").alias("text")),
        F.struct(F.lit("pkg/open.go").alias("path"), F.lit(BROKEN_FILE).alias("text")),
        F.struct(F.lit("pkg/large.go").alias("path"), F.repeat(F.lit("// large\n"), F.lit(TREE_FILE_BYTES // 9 + 1)).alias("text")),
    )
    sources = table(spark, sf_dir, "part").select(F.col("p_type").alias("source")).distinct()
    more = sources.select("source", F.inline(planted)).select("source", "path", F.encode("text", "UTF-8").alias("content"))
    found = manifests(spark, sf_dir).select("source", "path", F.encode("content", "UTF-8").alias("content"))
    return made.unionByName(more).unionByName(found)


def odd_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Markdown documents as files, each tenth in a folder and under a suffix of its own."""
    path = F.when(
        F.col("path").rlike(r"3\.md$"), F.regexp_replace("path", r"^docs/(.*)\.md$", "_more/$1.MD")
    ).otherwise(F.col("path"))
    return markdown(spark, sf_dir).select("source", path.alias("path"), F.encode("content", "UTF-8").alias("content"))


def write_files(files: DataFrame, root: str) -> int:
    """Files (source, path, content) written below a folder the executors share, each by the task
    that has its row. Returns their number."""
    address, base = walk.arrow_path(root)

    def written(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system = fs.FileSystem.from_uri(address)[0] if address else fs.LocalFileSystem()
        for batch in batches:
            for source, path, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                place = f"{base}/{source}/{path}"
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(place) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    done = files.select("source", "path", "content").mapInArrow(written, "files bigint")
    return done.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("n")).first()["n"]


def package_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as units of few packages, each with many files and names. Every other package has a
    documented init function, in its last file."""
    k, rank = F.col("p_partkey"), F.col("p_partkey") % 40
    is_init = (F.col("p_partkey") % 997 == 0) & (F.length("p_type") % 2 == 0)
    kinds = ["func", "method", "type_struct", "type_interface", "type_alias"]
    kind = F.element_at(F.array(*[F.lit(x) for x in kinds]), (k % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.when(is_init, F.lit("func")).otherwise(kind).alias("kind"),
        F.when(is_init, F.lit("init")).otherwise(F.concat(F.lit("N"), k)).alias("name"),
        F.lit("wide").alias("package_name"),
        F.concat(F.lit("example.org/"), F.lower("p_type")).alias("module_path"),
        F.concat(F.lit("wide/"), F.when(is_init, F.lit("z")).otherwise(F.lit("f")), F.lpad(rank.cast("string"), 2, "0"), F.lit(".go")).alias("file_path"),
        F.col("p_type").alias("project_name"),
        F.when(is_init | (k % 3 == 0), F.concat_ws(" ", F.lit("About"), "p_name", k)).otherwise(F.lit("")).alias("doc_comment"),
        k.cast("int").alias("line_number"),
        (~is_init & (k % 7 != 0)).alias("exported"),
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it (conv_id, turn, asked, told)."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    told = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("told")
    )
    return asked.join(told, ["conv_id", "turn"])


def pair_rows(spark: SparkSession, sf_dir: str, style: str) -> DataFrame:
    """Turn pairs as qa or instruction rows.

    The filled key depends on conv_id % 3. Some rows hold '' in an earlier key, some hold
    only blanks there, which hides the later keys.
    """
    from corpusflow.schemas import ANSWER_KEYS, QUESTION_KEYS

    pairs = turn_pairs(spark, sf_dir)
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    third = F.col("conv_id") % 3
    early = F.when(F.col("conv_id") % 7 == 3, F.lit(" \t")).when(F.col("conv_id") % 2 == 0, F.lit(""))

    def spread(keys, value):
        padded = F.concat(F.lit(" "), value, F.lit("\n"))
        out = []
        for i, k in enumerate(keys):
            out.append(F.when(third == i, padded).when(third > i, early).alias(k))
        return out

    columns = {k: c for k, c in zip(QUESTION_KEYS[style], spread(QUESTION_KEYS[style], F.col("asked")))}
    columns |= {k: c for k, c in zip(ANSWER_KEYS[style], spread(ANSWER_KEYS[style], F.col("told")))}
    return pairs.select(key.alias("row_key"), *columns.values())


def code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as code dataset rows. Lengths straddle the limits for code, doc and body."""
    code = F.expr(
        r"""case when p_partkey % 11 = 0 then 'func short() {}'
            when p_partkey % 11 = 1 then concat('// only text without a block ', repeat(p_name, p_size))
            else concat('func F', p_partkey, '(a int) {\n', repeat(concat('\tcall("', p_name, '")\n'), 1 + p_partkey % 7 * p_size),
              '} // end') end"""
    )
    doc = F.expr("substr(repeat(concat(p_name, ' '), 300), 1, case p_partkey % 4 when 0 then 0 when 1 then 30 when 2 then 31 else 2100 end)")
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("row_key"),
        F.when(k % 4 == 0, code).otherwise(F.lit("")).alias("func_code_string"),
        F.when(k % 4 == 1, code).alias("whole_func_string"),
        F.when(k % 4 == 2, code).alias("code"),
        F.when(k % 4 == 3, code).alias("content"),
        F.when(k % 3 == 0, doc).otherwise(F.lit("")).alias("func_documentation_string"),
        F.when(k % 3 == 1, doc).alias("docstring"),
        F.when(k % 3 == 2, doc).alias("comment"),
    )


def gapped_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations with some texts and roles blanked or set to null."""
    place = F.col("conv_id") + F.col("turn")
    text = (
        F.when(place % 7 == 3, F.lit(" \t\n"))
        .when(place % 11 == 5, F.lit(None))
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(place % 13 != 6, F.col("role")).alias("role"), text.alias("text")
    )


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as files of a tree: host, language and page number are the directories."""
    place = F.regexp_extract("url", r"^[a-z]+://([^?#]*?)/?(?:[?#].*)?$", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", F.lit("web").alias("source"), F.concat(place, F.lit("/main.go")).alias("path")
    )


def page_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of that tree: host directories of each third page, host/language directories
    of even pages."""
    parts = F.split("path", "/")
    pages = page_files(spark, sf_dir).select("page_id", parts[0].alias("host"), parts[1].alias("lang"))
    hosts = pages.filter("page_id % 3 = 0").select("host").distinct().select(F.col("host").alias("dir"))
    deeper = pages.filter("page_id % 2 = 0").select(F.concat_ws("/", "host", "lang").alias("dir")).distinct()
    return hosts.unionByName(deeper).select(
        F.lit("web").alias("source"), "dir", F.concat(F.lit("mod."), "dir").alias("module")
    )


def odd_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with paths that meet each path rule (page_id, path)."""
    folders = ["vendor/", "a/vendor/b/", "hack/", "docs/.github/", "docs/", "", "vendored/", "testdata/"]
    names = ["CHANGELOG.md", "x_test.go", "mock_a.go", "a.pb.go", "main.go", "README.MD", "Authors-list.md"]

    def chosen(values: list[str], number):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))

    page = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.concat(chosen(folders, page), chosen(names, F.floor(page / len(folders)))).alias("path")
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as training log lines (run, line_no, value)."""
    line = (
        F.when(
            F.col("event_type") == "view",
            F.format_string("Iter %d: Train loss %.2f, It/sec %.2f  ", "event_id", "value", F.col("value") * 2),
        )
        .when(F.col("event_type") == "click", F.format_string("Iter %d: Val loss %.2f", "event_id", "value"))
        .when(F.col("event_type") == "error", F.lit("  "))
        .otherwise(F.concat(F.lit("Saved "), "props"))
    )
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("run"), F.col("event_id").alias("line_no"), line.alias("value")
    )
