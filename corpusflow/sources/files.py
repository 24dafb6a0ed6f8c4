"""Source trees as rows (source, path, content), one row per file.

A tree that has been listed (see `walk`) is read inside tasks. Otherwise Spark's own reader lists and
reads what it sees, and only files it leaves out for their names are listed and read inside tasks.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.config import MAX_FILE_BYTES
from corpusflow.functions import text as tx
from corpusflow.operators.filters import is_markdown_path
from corpusflow.operators.modules import MANIFEST, read_manifests
from corpusflow.sources import walk
from corpusflow.sources.scratch import scratch_dir

FILE_SCHEMA = "source string, path string, content string"
CODE, MARKDOWN = "*.go", "*.[mM][dD]"
#: Put before hidden names in scratch copies.
HIDDEN = "corpusflow-hidden-"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """Path with its scheme, in the form the file readers report."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop_path).toString().rstrip("/")


def hidden_entries(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """Folders and files below a folder whose own names start with '_' or '.'.

    Spark's listing skips both. They are looked for level by level with globs.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    level, folders, plain = base.toString().rstrip("/"), [], []
    escaped = "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in level)
    while True:
        found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{escaped}/*"))
        if not found:
            return folders, plain
        for status in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{escaped}/[_.]*")) or []:
            (folders if status.isDirectory() else plain).append(status.getPath().toString())
        escaped += "/*"


def oversized_files(spark: SparkSession, root: str, most_bytes: int | None = None) -> DataFrame:
    """Paths and lengths of the files that a scan skips because one row can't hold them."""
    if walk.can_open(qualified(spark, root)):
        listed = walk.walk(spark, qualified(spark, root)).select("path", "length")
    else:
        folders, _ = hidden_entries(spark, root)
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([root, *folders]).select("path", "length")
    return listed.filter(F.col("length") > (most_bytes or MAX_FILE_BYTES))


def _visible_copies(spark: SparkSession, plain: list[str], root: str, glob: str | None) -> list[str]:
    """Copies of hidden files in a scratch folder under the same relative path, every name made
    visible. Only files whose name fits the glob are copied."""
    names = [p for p in plain if fnmatch.fnmatchcase(p.rsplit("/", 1)[1], glob or "*")]
    if not names:
        return []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = scratch_dir(spark, "hidden")
    start = len(_single_slash(qualified(spark, root))) + 1
    for name in names:
        source = jvm.org.apache.hadoop.fs.Path(name)
        shown = "/".join(HIDDEN + part for part in _single_slash(name)[start:].split("/"))
        target = jvm.org.apache.hadoop.fs.Path(f"{base}/{shown}")
        jvm.org.apache.hadoop.fs.FileUtil.copy(
            source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf
        )
    return [base]


def scan_tree(
    spark: SparkSession,
    root: str,
    source: str,
    glob: str | None = None,
    listed: DataFrame | None = None,
    most_bytes: int | None = None,
    sound: bool = False,
) -> DataFrame:
    """All files below a folder, text decoded tolerantly, path relative to the folder.

    With `listed`, the result of `walk.walk`, all files are read by tasks, a bounded number of bytes
    each: the driver doesn't list them again, and many small ones don't make many tasks. Paths alone
    are best taken from the listing then. Without it the name glob is applied while listing, and
    content is read only if a later step uses it. Folders and files with names that Spark's reader
    leaves out are then listed and read by tasks. On file systems that only Spark can open such
    folders are passed to it by name, and such files are copied to a visible name first.

    Files longer than `most_bytes` (by default what a row can hold) are skipped, and so are files
    that are gone or broken when they are read; `listed_counts` tells how many there are. `sound` adds a column
    that is false where bytes weren't valid UTF-8.
    """
    base, most_bytes = qualified(spark, root), most_bytes or MAX_FILE_BYTES
    if listed is not None:
        read = walk.contents(spark, base, _readable(listed, glob, most_bytes), most_bytes)
        return _read(read, source, sound)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if not walk.can_open(base):
        folders, plain = hidden_entries(spark, root)
        made = _relative(spark, reader.load([root, *folders]), root, source, most_bytes, sound)
        if copies := _visible_copies(spark, plain, root, glob):
            reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
            shown = _relative(spark, reader.load(copies), copies[0], source, most_bytes, sound)
            made = made.unionByName(shown.withColumn("path", F.regexp_replace("path", HIDDEN, "")))
        return made
    made = _relative(spark, reader.load([root]), root, source, most_bytes, sound)
    unseen = _readable(walk.walk(spark, base).filter("hidden"), glob, most_bytes)
    if unseen.isEmpty():
        return made
    return made.unionByName(_read(walk.read_listed(spark, base, unseen, most_bytes), source, sound))


def _readable(listed: DataFrame, glob: str | None, most_bytes: int) -> DataFrame:
    fitting = listed.filter((F.col("status") == walk.LISTED) & (F.col("length") <= most_bytes))
    return fitting.filter(tx.basename(F.col("path")).rlike(tx.glob_regex([glob]))) if glob else fitting


def _read(read: DataFrame, source: str, sound: bool) -> DataFrame:
    found = read.filter(F.col("status") == walk.READ)
    return found.select(F.lit(source).alias("source"), "path", *_decoded(sound))


def _decoded(sound: bool) -> list:
    text = [tx.decode_text(F.col("content")).alias("content")]
    return [*text, F.is_valid_utf8(F.col("content").cast("string")).alias("sound")] if sound else text


def _relative(spark: SparkSession, found: DataFrame, root: str, source: str, most_bytes: int, sound: bool) -> DataFrame:
    base = qualified(spark, root)
    return found.filter(F.col("length") <= most_bytes).select(
        F.lit(source).alias("source"),
        # Spark reports 'file:/x' and Hadoop may say 'file:///x'; both have one '/' + the rest.
        F.substring(
            F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/"),
            F.lit(len(_single_slash(base)) + 2),
            F.length("path"),
        ).alias("path"),
        *_decoded(sound),
    )


def listed_counts(listed: DataFrame, glob: str, most_bytes: int | None = None) -> dict[str, int]:
    """Of listed names (see `walk.walk`) that fit the glob: `readable` ones, those that are
    `oversized`, and folders that couldn't be listed, `unreadable`."""
    fits = tx.basename(F.col("path")).rlike(tx.glob_regex([glob])) & (F.col("status") == walk.LISTED)
    large = F.col("length") > (most_bytes or MAX_FILE_BYTES)
    counted = listed.agg(
        F.count_if(fits & ~large).alias("readable"),
        F.count_if(fits & large).alias("oversized"),
        F.count_if(F.col("status") == walk.UNREADABLE).alias("unreadable"),
    )
    return counted.first().asDict()


def _single_slash(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else path


def listed_paths(listed: DataFrame, source: str, glob: str, most_bytes: int) -> DataFrame:
    """(source, path) of the files that a scan of a listed tree reads."""
    return _readable(listed, glob, most_bytes).select(F.lit(source).alias("source"), "path")


def scan_code(spark: SparkSession, root: str, source: str, **options) -> DataFrame:
    return scan_tree(spark, root, source, CODE, **options)


def scan_manifests(spark: SparkSession, root: str, source: str, **options) -> DataFrame:
    return read_manifests(scan_tree(spark, root, source, MANIFEST, **options))


def scan_markdown(spark: SparkSession, root: str, source: str, **options) -> DataFrame:
    """Markdown files; the suffix may be in any case, which the listing glob can spell out."""
    return scan_tree(spark, root, source, MARKDOWN, **options).filter(is_markdown_path(F.col("path")))
