"""Turn rows against nested chats, with one conversation holding a third of all turns."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.config import CorpusConfig
from corpusflow.operators import chat_views, normalize, turns

CONFIG = CorpusConfig(system_prompt="sys", max_seq_length=20)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    roles = ["user", "assistant", "assistant", "system", "tool", None]
    texts = ["hi", "a longer text\nwith lines", " \t", "", None, "é\U0001d4b3"]
    rows = [
        (0 if i % 3 == 0 else rng.randrange(1, 200), i, rng.choice(roles), rng.choice(texts))
        for i in range(1500)
    ]
    return spark.createDataFrame(rows, "conv int, n int, role string, text string").repartition(8)


@pytest.fixture(scope="module")
def nested(table):
    arrays = normalize.nest_turns(table, "conv", "n", "role", "text")
    return normalize.normalize(arrays, "messages", CONFIG, "o", F.col("conv")).cache()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("chunk", [1, 40, 100_000])
def test_turn_rows_equal_nested_chats(table, nested, chunk):
    flat = turns.normalize_turns(table, "conv", "n", "role", "text", CONFIG, "o", chunk)
    exploded = nested.select("example_id", F.posexplode("conversations").alias("turn", "t")).select(
        "example_id", "turn", "t.*"
    )
    assert rows_of(flat) == rows_of(exploded)
    assert rows_of(turns.response_spans(flat, chunk)) == rows_of(chat_views.response_spans(nested))
    assert rows_of(turns.length_profile(flat, CONFIG)) == rows_of(chat_views.length_profile(nested, CONFIG))
    messages = nested.select("example_id", F.posexplode(normalize.chat.to_messages(F.col("conversations"))).alias("turn", "t"))
    assert rows_of(turns.message_turns(flat)) == rows_of(messages.select("example_id", "turn", "t.*"))


def test_turn_counts(table):
    got = {r.conv: (r.kept, r.null_turns) for r in turns.turn_counts(table, "conv", "role", "text").collect()}
    expected = {}
    for r in table.collect():
        kept, null = expected.get(r.conv, (0, 0))
        stays = r.role not in (None, "system") and bool((r.text or "").strip())
        expected[r.conv] = (kept + stays, null + (r.role is None or r.text is None))
    assert got == expected
