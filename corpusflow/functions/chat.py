"""Chat columns: constructors, role maps, rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role names of the two chat forms.
TO_CHAT_ROLE = {"user": "human", "assistant": "gpt"}
TO_MESSAGE_ROLE = {"human": "user", "gpt": "assistant"}

# Turn markers of the rendered text.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"


def map_role(role: Column, mapping: dict[str, str]) -> Column:
    """Mapped role; roles outside the mapping stay as they are."""
    known, *rest = mapping.items()
    out = F.when(role == known[0], F.lit(known[1]))
    for source, target in rest:
        out = out.when(role == source, F.lit(target))
    return out.otherwise(role)


def turn(role: Column | str, value: Column) -> Column:
    who = F.lit(role) if isinstance(role, str) else role
    return F.struct(who.alias("from"), value.alias("value"))


def system_turn(prompt: str) -> Column:
    return turn("system", F.lit(prompt))


def triple(prompt: str, question: Column, answer: Column) -> Column:
    """System, human and gpt turns."""
    return F.array(system_turn(prompt), turn("human", question), turn("gpt", answer))


def to_messages(conversations: Column) -> Column:
    """from/value turns to role/content messages."""
    return F.transform(
        conversations,
        lambda t: F.struct(
            map_role(t["from"], TO_MESSAGE_ROLE).alias("role"), t["value"].alias("content")
        ),
    )


def to_conversations(messages: Column) -> Column:
    """role/content messages to from/value turns."""
    return F.transform(
        messages, lambda m: turn(map_role(m["role"], TO_CHAT_ROLE), m["content"])
    )


def header(role: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit("\n"))


def render_turn(who: Column, value: Column) -> Column:
    return F.concat(header(map_role(who, TO_MESSAGE_ROLE)), value, F.lit(TURN_END + "\n"))


def render_turns(conversations: Column) -> Column:
    """Array of rendered turns, in order."""
    return F.transform(conversations, lambda t: render_turn(t["from"], t["value"]))


def render(conversations: Column) -> Column:
    return F.array_join(render_turns(conversations), "")
