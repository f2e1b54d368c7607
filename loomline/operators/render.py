"""Records as text: for fingerprints, token counts and training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import text


@dataclass(frozen=True)
class Chat:
    """Names of a training row's fields and roles, and the think tags."""

    column: str = "conversations"
    role: str = "from"
    content: str = "value"
    system: str = "system"
    user: str = "user"
    assistant: str = "assistant"
    think_open: str = "<think>"
    think_close: str = "</think>"


def record_text(messages: Column) -> Column:
    """Content and reasoning of every message, joined by spaces."""
    return F.array_join(F.transform(messages, lambda m: F.concat(text(m["content"]), F.lit(" "), text(m["reasoning"]))), " ")


def user_text(messages: Column) -> Column:
    return F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "user"), lambda m: text(m["content"])), " ")


def rendered(message: Column, mode: Column, chat: Chat) -> Column:
    """An assistant turn: ``none`` the answer alone; ``off``, or no reasoning,
    an empty think block before it; else the reasoning in the block."""
    bare = (mode == "off") | (F.length(text(message["reasoning"])) == 0)
    full = F.concat(F.lit(f"{chat.think_open}\n"), message["reasoning"], F.lit(f"\n{chat.think_close}\n\n"), message["content"])
    return F.when(mode == "none", message["content"]).when(bare, F.concat(F.lit(f"{chat.think_open}\n\n{chat.think_close}\n\n"), message["content"])).otherwise(full)


def conversations(messages: Column, mode: Column, chat: Chat = Chat()) -> Column:
    """The turns of a training row, as array<struct<role field, content field>>."""
    name = lambda m: F.when(m["role"] == "system", chat.system).when(m["role"] == "user", chat.user).otherwise(chat.assistant)
    value = lambda m: F.when(m["role"] == "assistant", rendered(m, mode, chat)).otherwise(m["content"])
    return F.transform(messages, lambda m: F.struct(name(m).alias(chat.role), value(m).alias(chat.content)))
