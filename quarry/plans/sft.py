"""Q13: chat SFT sequences from long conversation rows.

C8 assemble -> C1 roles -> C2 system -> C6 template -> encode -> truncate ->
pad -> Q5 assistant-span mask -> shift.  Before the per-conversation collect,
turns that cannot reach the truncated window are pruned exactly: every
rendered message is at least 4 tokens (im_start, >= 1 for "role\\n...",
im_end, newline), so kept message r (0-based, after the system message)
starts at token >= 4 * (r + 1).  The collected list is therefore bounded by
max_length / 4 whatever the conversation's size.  Turns are ranked by a window that every
task limits before rows move (``first_ranked``), so a hot conversation is cut where it is read.
Two exchanges in all: that one, and the partial sums of all turns' lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.constants import ASSISTANT_HEADER, CHAT_SYSTEM_PROMPT, EOS_ID, MAX_LENGTH, PAD_ID
from quarry.functions.arrays import (assistant_span_mask, pad_right, shift_mask, shift_x, shift_y,
                                     truncate)
from quarry.functions.chat import chat_role, prepend_system, render_chat, render_message
from quarry.functions.encode import BpeModel, encode, token_count
from quarry.functions.literal import encode_literal
from quarry.operators.conversations import conversation_ids, first_ranked
from quarry.sources.tables import raw_turns

MIN_TOKENS_PER_MESSAGE = 4


def assemble_messages(turns: DataFrame, max_messages: int | None = None, every: DataFrame | None = None) -> DataFrame:
    """C8 + C1 (+ C3 by construction): raw turn rows -> (conv_id, messages).

    A conversation whose turns are all dropped still yields an empty message
    list (the system message is added later), because emptiness is judged on
    the raw turns.  With ``max_messages`` only the first kept turns are
    collected (``first_ranked``).  ``every``: one row per
    conversation, whose columns are kept; made from the turns if not given.
    """
    role = chat_role(F.col("from"))
    kept = turns.withColumn("role", role).where(F.col("role").isNotNull())
    if max_messages is not None:
        kept = first_ranked(kept, max_messages)
    msg = F.struct("turn", "role", F.col("value").alias("content"))
    agg = kept.groupBy("conv_id").agg(F.sort_array(F.collect_list(msg)).alias("_m"))
    every = conversation_ids(turns).select("conv_id") if every is None else every
    full = every.join(agg, "conv_id", "left")
    return full.select(*every.columns, F.transform(F.coalesce("_m", F.array().cast(agg.schema["_m"].dataType)),
                                              lambda m: F.struct(m["role"].alias("role"),
                                                                 m["content"].alias("content")))
                       .alias("messages"))


def sft_sequences(conversations: DataFrame, model: BpeModel | None = None, max_length: int = MAX_LENGTH,
                  system_prompt: str = CHAT_SYSTEM_PROMPT, pad: int = PAD_ID, eos: int = EOS_ID,
                  normalize: bool = True) -> DataFrame:
    """Rows (conv_id, n_tokens, x, y, loss_mask) from long rows (conv_id, turn, role, text).

    ``n_tokens`` is the length before truncation: every message starts with a special
    token, so it is the sum of the messages' own lengths, taken over all turns by a
    partial aggregate.
    """
    raw = raw_turns(conversations)
    length = token_count(render_message(chat_role(F.col("from")), F.col("value")), model, normalize)
    system = len(encode_literal(f"<|im_start|>system\n{system_prompt}<|im_end|>\n", model, normalize))
    totals = raw.groupBy("conv_id").agg((F.coalesce(F.sum(length), F.lit(0)) + system).cast("int").alias("n_tokens"))
    msgs = assemble_messages(raw, max_length // MIN_TOKENS_PER_MESSAGE, totals)
    text = render_chat(prepend_system(F.col("messages"), system_prompt))
    ids = msgs.select("conv_id", "n_tokens", encode(text, model, normalize).alias("_ids"))
    header = encode_literal(ASSISTANT_HEADER, model)
    cut = ids.select("conv_id", "n_tokens",
                     pad_right(truncate(F.col("_ids"), max_length), max_length, pad).alias("_p"))
    masked = cut.select("conv_id", "n_tokens", "_p", assistant_span_mask(F.col("_p"), header, eos).alias("_m"))
    return masked.select("conv_id", "n_tokens", shift_x(F.col("_p")).alias("x"), shift_y(F.col("_p")).alias("y"),
                         shift_mask(F.col("_m")).alias("loss_mask"))
