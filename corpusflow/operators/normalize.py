"""Rows of external datasets to chat examples. Row-local, so batch and stream share them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.config import MIN_TURNS_WITH_PROMPT, CorpusConfig
from corpusflow.functions import chat
from corpusflow.functions import text as tx
from corpusflow.operators.examples import code_pairs
from corpusflow.operators.rows import keep_where


def nest_turns(turns: DataFrame, key: str, order: str, role: str, content: str) -> DataFrame:
    """Turn rows to one row per conversation with an ordered `messages` array.

    A conversation becomes one row here, so it has to fit one row. Data that arrives with
    nested messages does not need this step, nor its shuffle.
    """
    entry = F.struct(F.col(order), F.col(role).alias("role"), F.col(content).alias("content"))
    ordered = F.array_sort(F.collect_list(entry))
    return turns.groupBy(key).agg(
        F.transform(
            ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
        ).alias("messages")
    )


def kept_messages(messages: Column) -> Column:
    """Messages with a role other than system and some text. Null fields drop the message."""
    return F.filter(
        messages, lambda m: (m["role"] != "system") & ~tx.is_blank(m["content"])
    )


def dropped_messages(messages: Column) -> Column:
    """How many messages the filter removes because a field is null."""
    return F.size(
        F.filter(messages, lambda m: m["role"].isNull() | m["content"].isNull())
    )


def _first(df: DataFrame, keys: tuple[str, ...]) -> Column:
    """First filled field; fields the dataset does not have are left out."""
    return tx.first_non_empty(*[F.col(k) for k in keys if k in df.columns])


def _chats_of_messages(df: DataFrame, config: CorpusConfig) -> DataFrame:
    turns = chat.to_conversations(kept_messages(F.col("messages")))
    made = df.select(
        "*", F.concat(F.array(chat.system_turn(config.system_prompt)), turns).alias("__chat")
    )
    enough = F.size("__chat") >= MIN_TURNS_WITH_PROMPT
    return made.select(*df.columns, F.when(enough, F.col("__chat")).alias("conversations"))


def _chats_of_pairs(df: DataFrame, style: str, config: CorpusConfig) -> DataFrame:
    made = df.select(
        "*",
        tx.strip(_first(df, schemas.QUESTION_KEYS[style])).alias("__asked"),
        tx.strip(_first(df, schemas.ANSWER_KEYS[style])).alias("__told"),
    )
    asked, told = F.col("__asked"), F.col("__told")
    full = (asked != "") & (told != "")
    return made.select(
        *df.columns,
        F.when(full, chat.triple(config.system_prompt, asked, told)).alias("conversations"),
    )


def _chats_of_code(
    df: DataFrame, code_keys: tuple[str, ...], doc_keys: tuple[str, ...], config: CorpusConfig
) -> DataFrame:
    return code_pairs(
        df, _first(df, code_keys), _first(df, doc_keys), config.system_prompt, config.wording
    )


def with_chats(df: DataFrame, style: str, config: CorpusConfig) -> DataFrame:
    """Add `conversations` to rows of a style, null where a row makes no example."""
    if style == "messages":
        return _chats_of_messages(df, config)
    if style in schemas.QUESTION_KEYS:
        return _chats_of_pairs(df, style, config)
    return _chats_of_code(df, schemas.CODE_KEYS, schemas.DOC_KEYS, config)


def with_jsonl_chats(df: DataFrame, config: CorpusConfig) -> DataFrame:
    """Rows that hold a chat keep it unchanged, the others are code rows."""
    if "conversations" not in df.columns:
        return _chats_of_code(df, schemas.JSONL_CODE_KEYS, schemas.JSONL_DOC_KEYS, config)
    landed = df.withColumnRenamed("conversations", "__own")
    made = _chats_of_code(landed, schemas.JSONL_CODE_KEYS, schemas.JSONL_DOC_KEYS, config)
    return made.withColumn("conversations", F.coalesce("__own", "conversations")).drop("__own")


def example_id(origin: str, key: Column) -> Column:
    return F.concat_ws("|", F.lit(origin), key.cast("string")).alias("example_id")


def _as_examples(
    df: DataFrame, origin: str, key: Column, example_type: str, *more: Column
) -> DataFrame:
    return keep_where(
        df,
        F.col("conversations").isNotNull(),
        example_id(origin, key),
        F.lit(origin).alias("origin"),
        F.lit(example_type).alias("example_type"),
        "conversations",
        *more,
    )


def normalize(df: DataFrame, style: str, config: CorpusConfig, origin: str, key: Column) -> DataFrame:
    """Rows in one of the styles messages, qa, instruction, code to examples."""
    return _as_examples(with_chats(df, style, config), origin, key, style)


def normalize_jsonl(df: DataFrame, config: CorpusConfig, origin: str, key: Column) -> DataFrame:
    """Chat and code rows to examples. Where the line itself is known (`raw`), a chat keeps it."""
    if "raw" not in df.columns:
        return _as_examples(with_jsonl_chats(df, config), origin, key, "jsonl")
    marked = df.withColumn("__chat", F.col("conversations").isNotNull())
    own = F.when(F.col("__chat"), F.col("raw")).alias("raw")
    return _as_examples(with_jsonl_chats(marked, config), origin, key, "jsonl", own)
