"""Chats kept as turn rows, for tables where one conversation can be very long.

Nothing here gathers a conversation. Running totals are computed in chunks of the turn
order: inside a chunk by a window, across chunks through a table of one row per chunk. A
conversation with any share of all turns is thus spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.config import MIN_TURNS_WITH_PROMPT, CorpusConfig
from corpusflow.functions import chat
from corpusflow.functions import text as tx

CHUNK = 100_000


def running_total(
    df: DataFrame, key: str, order: str, amount: Column, name: str, chunk: int = CHUNK
) -> DataFrame:
    """Add `name`_before, the sum of `amount` over the earlier rows of the key, and
    `name`_total, its sum over all rows of the key."""
    rows = df.withColumn("__amount", amount).withColumn("__chunk", F.floor(F.col(order) / chunk))
    sums = rows.groupBy(key, "__chunk").agg(F.sum("__amount").alias("__sum"))
    of_key = W.partitionBy(key)
    earlier = of_key.orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        key,
        "__chunk",
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"),
        F.sum("__sum").over(of_key).alias(f"{name}_total"),
    )
    inside = W.partitionBy(key, "__chunk").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
        .join(offsets, [key, "__chunk"])
        .withColumn(f"{name}_before", F.col("__offset") + F.col("__inside"))
        .drop("__amount", "__chunk", "__inside", "__offset")
    )


def normalize_turns(
    turns: DataFrame, key: str, order: str, role: str, content: str, config: CorpusConfig,
    origin: str, chunk: int = CHUNK,
) -> DataFrame:
    """Turn rows to chat turn rows (example_id, turn, from, value).

    The same rules as for nested messages: system and blank turns drop out, a chat needs
    two turns besides the prompt, and the configured prompt becomes turn 0.
    """
    kept = turns.select(key, order, F.col(role).alias("role"), F.col(content).alias("content")).filter(
        (F.col("role") != "system") & ~tx.is_blank(F.col("content"))
    )
    counted = running_total(kept, key, order, F.lit(1), "kept", chunk).filter(
        F.col("kept_total") >= MIN_TURNS_WITH_PROMPT - 1
    )

    def row(number: Column, who: Column, value: Column) -> Column:
        return F.struct(number.cast("bigint").alias("turn"), who.alias("from"), value.alias("value"))

    own = row(
        F.col("kept_before") + 1, chat.map_role(F.col("role"), chat.TO_CHAT_ROLE), F.col("content")
    )
    prompt = row(F.lit(0), F.lit("system"), F.lit(config.system_prompt))
    return counted.select(
        F.concat_ws("|", F.lit(origin), F.col(key).cast("string")).alias("example_id"),
        F.inline(F.when(F.col("kept_before") == 0, F.array(prompt, own)).otherwise(F.array(own))),
    )


def message_turns(turns: DataFrame) -> DataFrame:
    """Chat turn rows in role/content form."""
    return turns.select(
        "example_id", "turn",
        chat.map_role(F.col("from"), chat.TO_MESSAGE_ROLE).alias("role"),
        F.col("value").alias("content"),
    )


def _rendered_length() -> Column:
    return F.length(chat.render_turn(F.col("from"), F.col("value")))


def response_spans(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """[start, stop) of each assistant turn in the rendered text of its chat.

    Only lengths are shuffled, never the texts.
    """
    sized = turns.select("example_id", "turn", "from", _rendered_length().alias("size"))
    placed = running_total(sized, "example_id", "turn", F.col("size"), "size", chunk)
    lead = len(f"{chat.TURN_START}assistant\n")
    return placed.filter(F.col("from") == "gpt").select(
        "example_id",
        "turn",
        (F.col("size_before") + lead).alias("start"),
        (F.col("size_before") + F.col("size")).alias("stop"),
    )


def length_profile(turns: DataFrame, config: CorpusConfig) -> DataFrame:
    """Turns, characters, estimated tokens and budget flag per chat, map-side combined."""
    sized = turns.groupBy("example_id").agg(
        F.count("*").alias("turns"), F.sum(_rendered_length()).alias("chars")
    )
    estimate = F.ceil(F.col("chars") / F.lit(config.chars_per_token))
    return sized.withColumn("est_tokens", estimate).withColumn(
        "over_budget", F.col("est_tokens") > config.max_seq_length
    )


def turn_counts(turns: DataFrame, key: str, role: str, content: str) -> DataFrame:
    """Per conversation: turns that stay, and turns dropped because a field is null."""
    gone = F.col(role).isNull() | F.col(content).isNull()
    stays = (F.col(role) != "system") & ~tx.is_blank(F.col(content))
    return turns.groupBy(key).agg(
        F.count_if(stays).alias("kept"), F.count_if(gone).alias("null_turns")
    )
