"""Conversation shaping on message arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.constants import (CHAT_SYSTEM_PROMPT, GENERATION_PROMPT, TEMPLATE_ROLES,
                              TURN_ROLE_ASSISTANT, TURN_ROLE_HUMAN)

MESSAGES_TYPE = "array<struct<role:string,content:string>>"
RAW_TURNS_TYPE = "array<struct<from:string,value:string>>"


def chat_role(raw_from: Column) -> Column:
    """C1 per turn: human -> user; gpt / assistant -> assistant; anything else NULL (dropped)."""
    return (F.when(raw_from == "human", "user")
            .when(raw_from.isin("gpt", "assistant"), "assistant"))


def to_messages(turns: Column) -> Column:
    """Raw turns -> messages, dropping unknown roles, order kept."""
    kept = F.filter(turns, lambda t: chat_role(t["from"]).isNotNull())
    return F.transform(kept, lambda t: F.struct(chat_role(t["from"]).alias("role"),
                                                t["value"].alias("content")))


def prepend_system(messages: Column, text: str = CHAT_SYSTEM_PROMPT) -> Column:
    """System message always first."""
    sys = F.array(F.struct(F.lit("system").alias("role"), F.lit(text).alias("content")))
    return F.concat(sys, messages)


def non_empty(turns: Column) -> Column:
    """C3 predicate: keep conversations whose raw turn list is present and non-empty."""
    return F.size(F.coalesce(turns, F.array())) > 0


def drop_leading_non_human(turns: Column) -> Column:
    """C4: if turn 0 is not from a human, drop exactly that one turn."""
    return F.when((F.size(turns) > 0) & (turns[0]["from"] != "human"),
                  F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(1)))
                  ).otherwise(turns)


def turn_role(raw_from: Column) -> Column:
    """Human and assistant kept; every other role (gpt included) becomes human."""
    return F.when(raw_from == TURN_ROLE_ASSISTANT, TURN_ROLE_ASSISTANT).otherwise(TURN_ROLE_HUMAN)


def render_message(role: Column, content: Column) -> Column:
    """One template message: <|im_start|>{role}\\n{content}<|im_end|>\\n (known roles only)."""
    return F.when(role.isin(*TEMPLATE_ROLES),
                  F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.coalesce(content, F.lit("")),
                           F.lit("<|im_end|>\n")))


def render_chat(messages: Column, add_generation_prompt: bool = False) -> Column:
    """The chat template over a message array."""
    body = F.array_join(F.transform(messages, lambda m: render_message(m["role"], m["content"])), "")
    return F.concat(body, F.lit(GENERATION_PROMPT)) if add_generation_prompt else body
