"""Adapters: raw rows of a source -> chat records.

A record is id, source, name, source_rank, idx, domain, messages
(role, content, reasoning), reasoning_present, license and a closed struct of
metadata.  Records without a user text or an answer are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, filled, once, prose_parts, text, think_parts, told
from ..sources.catalog import Source

MESSAGE = "struct<role:string,content:string,reasoning:string>"
MESSAGES = f"array<{MESSAGE}>"

#: Role names of the two chat layouts (fixed values).
FROM_ROLES = {
    "human": "user", "user": "user",
    "gpt": "assistant", "assistant": "assistant", "chatgpt": "assistant",
    "system": "system",
    "tool": "user", "function": "user", "observation": "user", "function_response": "user",
}
PLAIN_ROLES = {"user": "user", "assistant": "assistant", "system": "system", "tool": "user"}
#: Domains that a row may name for itself (fixed values).
ROW_DOMAINS = ("code", "math", "science", "chat", "reasoning")


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.lower(text(key)))


def message(role: str | Column, content: Column, reasoning: Column | None = None) -> Column:
    who = F.lit(role) if isinstance(role, str) else role
    return F.struct(who.alias("role"), content.alias("content"), (F.lit(None) if reasoning is None else reasoning).cast("string").alias("reasoning")).cast(MESSAGE)


def native_id(df: DataFrame) -> Column:
    """The row's own id, from the first column that has one; else its line number."""
    own = [filled(F.col(c).cast("string")) for c in ("id", "uuid", "seq_id", "_instance_id") if c in df.columns]
    return F.coalesce(*own, F.col("idx").cast("string"))


def record_id(source: Column, native: Column, user: Column) -> Column:
    return F.sha2(F.concat(source, F.lit("\0"), native, F.lit("\0"), user), 256)


def has_text(messages: Column, role: str) -> Column:
    return F.exists(messages, lambda m: (m["role"] == role) & told(text(m["content"])))


def reasons(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.length(text(m["reasoning"])) > 0)


def first_user(messages: Column) -> Column:
    return F.coalesce(F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"], F.lit(""))


def clean_turns(turns: Column, role: str, content: str, roles: dict[str, str]) -> Column:
    """Turns of known roles with a text; assistant turns are split into
    reasoning and answer, others stay as they are."""
    named = F.transform(turns, lambda t: F.struct(lookup(roles, t[role]).alias("who"), text(t[content]).alias("said")))
    known = F.filter(named, lambda t: t["who"].isNotNull() & told(t["said"]))
    answer = lambda t: bound(think_parts(t["said"]), lambda p: message("assistant", p["answer"], p["reasoning"]))
    turn = lambda t: F.when(t["who"] == "assistant", answer(t)).otherwise(message(t["who"], t["said"]))
    return F.coalesce(F.transform(known, turn), F.array().cast(MESSAGES))


def two_turns(user: Column, answer: Column, reasoning: Column) -> Column:
    return F.array(message("user", user), message("assistant", answer, reasoning))


def answered(user: Column, parts: Column) -> Column:
    """A user's turn and an answer of struct<reasoning, answer>, which is computed once."""
    return bound(parts, lambda p: two_turns(user, p["answer"], p["reasoning"]))


def _column(df: DataFrame, name: str | None) -> Column:
    return F.col(name) if name and name in df.columns else F.lit(None).cast("string")


def _instruct(df: DataFrame, s: Source) -> tuple[Column, dict]:
    user, output = text(_column(df, s.columns["instruction"])), text(_column(df, s.columns["output"]))
    expected = _column(df, s.columns.get("answer"))
    parts = think_parts(output)
    if s.prose:
        parts = bound(parts, lambda p: F.when(p["reasoning"].isNull(), prose_parts(output, expected)).otherwise(p))
    rate = _column(df, s.columns.get("pass_rate"))
    return answered(user, parts), {"expected_answer": expected.cast("string"), "pass_rate": rate.try_cast("double")}


def _messages(df: DataFrame, s: Source) -> tuple[Column, dict]:
    return clean_turns(F.col(s.columns["messages"]), "role", "content", PLAIN_ROLES), {}


def _sharegpt(df: DataFrame, s: Source) -> tuple[Column, dict]:
    own = F.lower(text(_column(df, s.columns.get("domain_field"))))
    domain = F.when(own.isin(*ROW_DOMAINS), own).otherwise(F.lit(s.domain))
    return clean_turns(F.col(s.columns["conversations"]), "from", "value", FROM_ROLES), {"domain": domain}


def pick_generation(generations: Column, verified: Column, solution: Column) -> Column:
    """The first verified generation, else the first, else the solution."""
    pairs = F.arrays_zip(generations.alias("g"), verified.alias("v"))
    good = F.get(F.filter(pairs, lambda p: F.coalesce(p["v"], F.lit(False)) & p["g"].isNotNull()), F.lit(0))["g"]
    return F.coalesce(filled(good), filled(F.get(generations, F.lit(0))), text(solution))


def _openr1(df: DataFrame, s: Source) -> tuple[Column, dict]:
    c = s.columns
    picked = pick_generation(F.col(c.get("generations", "generations")), F.col(c.get("verify", "correctness_math_verify")), _column(df, c.get("solution", "solution")))
    user, other = text(_column(df, c["problem"])), filled(text(_column(df, c.get("answer", "answer"))))
    best = lambda p, whole: F.coalesce(filled(p["answer"]), other, whole)
    return bound(picked, lambda whole: bound(think_parts(whole), lambda p: two_turns(user, best(p, whole), p["reasoning"]))), {}


def _s1k(df: DataFrame, s: Source) -> tuple[Column, dict]:
    c = s.columns
    kind = df.schema[c["reasoning"]].dataType.typeName()
    trace = F.get(F.col(c["reasoning"]), F.lit(0)) if kind == "array" else filled(F.col(c["reasoning"]))
    answer = F.coalesce(filled(text(_column(df, c.get("attempt")))), text(_column(df, c.get("solution"))))
    return two_turns(text(_column(df, c["question"])), answer, trace), {}


def _limo(df: DataFrame, s: Source) -> tuple[Column, dict]:
    c = s.columns
    working, short = filled(text(_column(df, c["solution"]))), filled(text(_column(df, c.get("answer"))))
    return two_turns(text(_column(df, c["question"])), F.coalesce(short, working, F.lit("")), F.when(short.isNotNull(), working)), {}


ADAPTERS: dict[str, Callable[[DataFrame, Source], tuple[Column, dict]]] = {
    "instruct": _instruct, "messages": _messages, "sharegpt": _sharegpt, "openr1": _openr1, "s1k": _s1k, "limo": _limo,
}


def records(df: DataFrame, s: Source, rank: int = 0) -> DataFrame:
    """Chat records of a source's raw rows, which have ``idx``."""
    messages, more = ADAPTERS[s.kind](df, s)
    at = df.select("idx", native_id(df).alias("_native"), messages.alias("messages"), more.get("domain", F.lit(s.domain)).alias("domain"), more.get("expected_answer", F.lit(None)).cast("string").alias("_expected"), more.get("pass_rate", F.lit(None)).cast("double").alias("_rate"))
    return assemble(at.withColumn("source", F.lit(s.id)).withColumn("name", F.lit(s.name)).withColumn("source_rank", F.lit(rank)).withColumn("license", F.lit(s.license)).withColumn("_config", F.lit(s.config).cast("string")))


def assemble(at: DataFrame) -> DataFrame:
    """Records from messages and their bookkeeping; rows without a user text or an answer go."""
    at = at.withColumn("messages", once(F.col("messages"))).filter(told(first_user(F.col("messages"))) & has_text(F.col("messages"), "assistant"))
    meta = F.struct(F.col("name").alias("name"), F.col("_config").alias("config"), F.col("_expected").alias("expected_answer"), F.col("_rate").alias("pass_rate"), F.lit(None).cast("string").alias("reasoning_mode"))
    return at.select(
        record_id(F.col("source"), F.col("_native"), first_user(F.col("messages"))).alias("id"), "source", "name", "source_rank", F.col("idx").cast("long").alias("idx"),
        "domain", "messages", reasons(F.col("messages")).alias("reasoning_present"), "license", meta.alias("meta"),
    )


def clean_pairs(value: Column, role: str, content: str) -> Column:
    """Turns of a JSON list that have both fields; none unless there are two."""
    turns = F.filter(F.from_json(value, f"array<struct<`{role}`:string,`{content}`:string>>"), lambda t: t[role].isNotNull() & t[content].isNotNull())
    return F.when(F.size(turns) > 1, turns).otherwise(F.slice(turns, F.lit(1), F.lit(0)))
