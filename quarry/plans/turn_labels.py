"""Q14 (C4, C5, C7, Q6, Q7): turn-labelled SFT samples.

Turns are first ranked by a window that every task limits before rows move
(``first_ranked``), since those beyond the limit cannot start inside ``max_len``; windows and
collects then see bounded groups, in the partitions of that one exchange.
Each turn is encoded on its own row (narrow); labels follow the role rule:
human -> [im_start] + [-100] * (L - 3) + [im_end, nl]; assistant ->
[im_start] + [-100] * R + value ids + [im_end, nl].  Before collecting a
conversation, turns that start at or beyond ``max_len`` are pruned exactly
with a running sum of turn lengths, so the collected arrays stay within
``max_len`` tokens whatever the conversation's size.  C4 (drop a leading
non-human turn) is computed in the same window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.constants import (BOS_TOKEN, EOS_ID, IGNORE_INDEX, IM_START_ID, PAD_ID, TURN_MAX_LENGTH,
                              TURN_ROLE_ASSISTANT, TURN_ROLE_HUMAN, TURN_SYSTEM_PROMPT)
from quarry.functions.arrays import attention_mask, pad_right, truncate
from quarry.functions.chat import turn_role
from quarry.functions.encode import BpeModel, encode
from quarry.functions.literal import encode_literal
from quarry.operators.conversations import conversation_ids, first_ranked
from quarry.sources.tables import raw_turns

MIN_TOKENS_PER_TURN = 5


def _lit_ids(ids: list[int]):
    return F.array(*[F.lit(i) for i in ids]).cast("array<int>")


def system_piece(model: BpeModel | None, system_prompt: str) -> tuple[list[int], list[int]]:
    nl = encode_literal("\n", model)
    ids = [IM_START_ID] + encode_literal("system", model) + nl + encode_literal(system_prompt, model) + [EOS_ID] + nl
    labels = [IM_START_ID] + [IGNORE_INDEX] * (len(ids) - 3) + [EOS_ID] + nl
    return ids, labels


def turn_pieces(turns: DataFrame, model: BpeModel | None = None, normalize: bool = True) -> DataFrame:
    """Per raw turn row: (conv_id, turn, from, ids, labels) — C5 + C7 + Q6 per turn."""
    nl = encode_literal("\n", model)
    role_ids = {r: encode_literal(BOS_TOKEN + r, model) for r in (TURN_ROLE_HUMAN, TURN_ROLE_ASSISTANT)}
    role = turn_role(F.col("from"))
    r_ids = F.when(role == TURN_ROLE_ASSISTANT, _lit_ids(role_ids[TURN_ROLE_ASSISTANT])) \
        .otherwise(_lit_ids(role_ids[TURN_ROLE_HUMAN]))
    tail = _lit_ids([EOS_ID] + nl)
    v = encode(F.coalesce("value", F.lit("")), model, normalize)  # a NULL content is empty text
    with_v = turns.select("conv_id", "turn", "from", role.alias("_role"), r_ids.alias("_r"), v.alias("_v"))
    ids = F.concat("_r", _lit_ids(nl), "_v", tail)
    lab_asst = F.concat(F.array(F.lit(IM_START_ID)), F.array_repeat(F.lit(IGNORE_INDEX), F.size("_r")), "_v", tail)
    lab_human = F.concat(F.array(F.lit(IM_START_ID)), F.array_repeat(F.lit(IGNORE_INDEX), F.size(ids) - 3), tail)
    return with_v.select("conv_id", "turn", "from", ids.alias("ids"),
                         F.when(F.col("_role") == TURN_ROLE_ASSISTANT, lab_asst).otherwise(lab_human)
                         .alias("labels"))


def turn_label_sequences(conversations: DataFrame, model: BpeModel | None = None,
                         max_len: int = TURN_MAX_LENGTH, system_prompt: str = TURN_SYSTEM_PROMPT,
                         pad: int = PAD_ID, normalize: bool = True) -> DataFrame:
    """Rows (conv_id, input_ids, labels, attention_mask), all of width max_len."""
    sys_ids, sys_labels = system_piece(model, system_prompt)
    raw = raw_turns(conversations)
    # every turn is at least 5 tokens (im_start, role, nl, im_end, nl): turns ranked
    # beyond this bound (one extra for a dropped first turn) start past max_len
    bound = max_len // MIN_TOKENS_PER_TURN + 2
    near = first_ranked(raw, bound)
    pieces = turn_pieces(near, model, normalize)
    w = Window.partitionBy("conv_id").orderBy("turn")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    n = F.size("ids")
    first_from = F.first("from").over(w.rowsBetween(Window.unboundedPreceding, 0))
    first_len = F.first(n).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rn = F.row_number().over(w)
    first_dropped = first_from != "human"
    start = (F.lit(len(sys_ids)) + F.coalesce(F.sum(n).over(before), F.lit(0))
             - F.when(first_dropped & (rn > 1), first_len).otherwise(0))
    keep = ~((rn == 1) & first_dropped) & (start < max_len)
    marked = pieces.withColumn("_keep", keep)
    agg = marked.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("_keep"), F.struct("turn", "ids", "labels")))).alias("_t"))
    agg = conversation_ids(raw).select("conv_id").join(agg, "conv_id", "left") \
        .withColumn("_t", F.coalesce("_t", F.array().cast(agg.schema["_t"].dataType)))
    ids = F.concat(_lit_ids(sys_ids), F.flatten(F.transform("_t", lambda t: t["ids"])))
    labels = F.concat(_lit_ids(sys_labels), F.flatten(F.transform("_t", lambda t: t["labels"])))
    out = agg.select("conv_id", pad_right(truncate(ids, max_len), max_len, pad).alias("input_ids"),
                     pad_right(truncate(labels, max_len), max_len, IGNORE_INDEX).alias("labels"))
    return out.withColumn("attention_mask", attention_mask(F.col("input_ids"), pad))
