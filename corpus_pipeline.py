"""From raw documents to token ids: stages that run one after another, each on what is left.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one token
ids. `run` writes each stage's result to the shared folder and reads it again, so a stage is
computed once and a lost executor costs no earlier stage.

Nulls: a null text is an empty one for the classifier, the removal of repeats, decontamination and
tokens; the near-duplicate stage keeps every null text. A null doc_id, or one that names several
texts, is no hindrance: a row counts by its doc_id and text. Further columns of documents pass
through all stages as they are, whatever their names; the last one leaves out text and n_chars, and
its own columns replace others of their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import bag_minhash, byte_bpe, quality, suffix_buckets, winnowing
from corpusflow.llm.runtime import fold, packed, prepare_lean, unpacked
from corpusflow.sources.scratch import stage

ACCEPTED = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.7 or more."""
    prepare_lean(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, taught=fold(F.col("k"), 4) != 2)
    scored = quality.score(packed(docs, "text"), model)
    return scored.filter(F.col("score") >= ACCEPTED).select(*unpacked(scored.drop("score"), docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id, see `bag_minhash`.

    Rows that repeat a doc_id and its text are one document; rows without a text all stay.
    """
    prepare_lean(spark)
    found = stage(bag_minhash.near_duplicates(docs), "classes")
    # A table of its own, so that Spark knows how small it is and leaves the texts where they are.
    gone = stage(found.filter("not kept and digest is null").select("doc_id"), "duplicates")
    left = packed(docs, "doc_id", "text").join(gone, "doc_id", "left_anti")
    odd = stage(found.filter("not kept and digest is not null").select(F.col("doc_id").alias("id"), "digest"), "odd-duplicates")
    if not odd.isEmpty():
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.sha2("text", 256) == F.col("digest"))
        left = left.join(odd, same, "left_anti")
    ids = docs.filter("text is not null").groupBy("doc_id").count().filter("count > 1")
    if not ids.isEmpty():
        left = left.filter("text is null").unionByName(left.filter("text is not null").dropDuplicates(["doc_id", "text"]))
    return left.select(*unpacked(left, docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of 200 bytes that occur elsewhere too. All rows stay.

    Bytes of a character that is cut in two are dropped with it; n_chars is counted anew.
    """
    prepare_lean(spark)
    cut = suffix_buckets.without_repeats(packed(docs, "doc_id", "text"))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    fresh = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fresh["n_chars"] = F.when(F.col("n_removed") == 0, F.col("given.n_chars")).otherwise(F.length(text).cast(kind))
    return cut.select(*unpacked(cut.select("given", "doc_id", "text"), docs, **fresh))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item (or all of a shorter item)."""
    prepare_lean(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = packed(docs, "text").select("given", "text", F.col("text").alias("words"))
    clean = winnowing.contamination(whole, items, text="words").filter("n_hit = 0")
    return clean.select(*unpacked(clean.select("given", "text"), docs))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    prepare_lean(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # Workers live on into later stages and runs, so they keep nothing beyond a task.
    coded = byte_bpe.encode(packed(docs, "text"), ranks, public_tokenizers.PATTERN, remember=False)
    coded = byte_bpe.decode(coded.drop("text"), ranks, remember=False)
    new = {
        "n_tokens": F.size("ids").cast("bigint"),
        "ids": F.col("ids"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
        "decoded_sha256": F.sha2(F.col("bytes"), 256),
    }
    kept = docs.drop("text", "n_chars", *new)
    return coded.select(*unpacked(coded.select("given"), kept), *[c.alias(name) for name, c in new.items()])


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("repeated substrings", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", encode_bytes),
]

#: The classifier is fitted, and the substring stage works on bytes: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), "stage")
    return docs
