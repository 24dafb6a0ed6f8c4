"""Training views of chat examples. All row-local."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.config import CorpusConfig
from corpusflow.functions import chat


def to_messages(examples: DataFrame) -> DataFrame:
    """Chat examples in role/content form."""
    return examples.withColumn("messages", chat.to_messages(F.col("conversations"))).drop("conversations")


def render_text(examples: DataFrame) -> DataFrame:
    """Add `text`, the whole chat as one marked-up string."""
    return examples.withColumn("text", chat.render(F.col("conversations")))


def render_prompts(questions: DataFrame, question: str, config: CorpusConfig) -> DataFrame:
    """Add `prompt`: system prompt, question, and an open assistant header."""
    turns = F.array(chat.system_turn(config.system_prompt), chat.turn("human", F.col(question)))
    return questions.withColumn(
        "prompt", F.concat(chat.render(turns), chat.header(F.lit("assistant")))
    )


def response_spans(examples: DataFrame) -> DataFrame:
    """One row per assistant turn: [start, stop) of the text that counts for the loss.

    Offsets are characters of the rendered text. A span starts after the assistant header
    and includes the end-of-turn marker.
    """
    rendered = chat.render_turns(F.col("conversations"))
    sized = F.zip_with(
        F.transform(F.col("conversations"), lambda t: t["from"]),
        F.transform(rendered, F.length),
        lambda who, size: F.struct(who.alias("who"), size.alias("size")),
    )
    lead = len(f"{chat.TURN_START}assistant\n")
    span = "struct<turn:int,start:int,stop:int>"
    state = f"struct<turn:int,at:int,spans:array<{span}>>"
    begin = F.struct(
        F.lit(0).alias("turn"), F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans")
    ).cast(state)

    def step(s, t):
        found = F.array(
            F.struct(
                s["turn"].alias("turn"),
                (s["at"] + lead).alias("start"),
                (s["at"] + t["size"]).alias("stop"),
            )
        )
        return F.struct(
            (s["turn"] + 1).alias("turn"),
            (s["at"] + t["size"]).alias("at"),
            F.when(t["who"] == "gpt", F.concat(s["spans"], found)).otherwise(s["spans"]).alias("spans"),
        ).cast(state)

    spans = F.aggregate(sized, begin, step, lambda s: s["spans"])
    return examples.select("example_id", F.inline(spans))


def length_profile(examples: DataFrame, config: CorpusConfig) -> DataFrame:
    """Rendered length, estimated tokens and whether the example exceeds the budget.

    The estimate divides characters by a configured ratio. It is not a tokenizer count.
    """
    chars = F.length(chat.render(F.col("conversations")))
    sized = examples.select(
        "example_id", F.size("conversations").alias("turns"), chars.alias("chars")
    )
    estimate = F.ceil(F.col("chars") / F.lit(config.chars_per_token))
    return sized.withColumn("est_tokens", estimate).withColumn(
        "over_budget", F.col("est_tokens") > config.max_seq_length
    )
