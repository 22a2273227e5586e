from pyspark.sql import functions as F

from quarry.functions.chat import (RAW_TURNS_TYPE, drop_leading_non_human, prepend_system, render_chat,
                                   to_messages, turn_role)
from quarry.functions.literal import encode_literal
from quarry.plans.turn_labels import turn_label_sequences


def _turns(spark, *convs):
    return spark.createDataFrame([([{"from": f, "value": v} for f, v in c],) for c in convs], f"c {RAW_TURNS_TYPE}")


def test_c1_c2_roles(spark):
    df = _turns(spark, [("human", "q"), ("bot", "x"), ("gpt", "a")], [("bot", "x")])
    out = df.select(prepend_system(to_messages(F.col("c"))).alias("m")).collect()
    assert [[m.role for m in r.m] for r in out] == [["system", "user", "assistant"], ["system"]]


def test_c4_c5(spark):
    df = _turns(spark, [("system", "s"), ("system", "t"), ("human", "h")], [("human", "h"), ("gpt", "g")])
    out = df.select(drop_leading_non_human(F.col("c")).alias("c")).collect()
    assert [[t["from"] for t in r.c] for r in out] == [["system", "human"], ["human", "gpt"]]
    roles = spark.createDataFrame([("gpt",), ("assistant",), ("human",), ("system",)], "f string") \
        .select(turn_role(F.col("f")).alias("r")).collect()
    assert [r.r for r in roles] == ["human", "assistant", "human", "human"]


def test_c6_render(spark):
    msgs = [{"role": "system", "content": "你是一个AI助手"}, {"role": "user", "content": "你好"},
            {"role": "assistant", "content": "你好！有什么可以帮助你的吗？"}, {"role": "tool", "content": "x"}]
    df = spark.createDataFrame([(msgs,)], "m array<struct<role:string,content:string>>")
    r = df.select(render_chat(F.col("m")).alias("t"), render_chat(F.col("m"), True).alias("g")).collect()[0]
    exp = ("<|im_start|>system\n你是一个AI助手<|im_end|>\n<|im_start|>user\n你好<|im_end|>\n"
           "<|im_start|>assistant\n你好！有什么可以帮助你的吗？<|im_end|>\n")
    assert r.t == exp and r.g == exp + "<|im_start|>assistant\n"


def test_q6_q14_turn_labels(spark):
    # even conv_id: assistant stays assistant (odd ids become "gpt", which C5 maps to human)
    conv = spark.createDataFrame([(2, 0, "user", "hi"), (2, 1, "assistant", "ok"), (3, 0, "assistant", "x")],
                                 "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in turn_label_sequences(conv, max_len=64).collect()}
    nl = encode_literal("\n")
    sys_ids = [3] + encode_literal("system") + nl + encode_literal("You are a helpful assistant.") + [4] + nl
    human = [3] + encode_literal("human") + nl + encode_literal("hi") + [4] + nl
    asst_r = [3] + encode_literal("assistant")
    asst = asst_r + nl + encode_literal("ok") + [4] + nl
    ids = sys_ids + human + asst
    labels = ([3] + [-100] * (len(sys_ids) - 3) + [4] + nl + [3] + [-100] * (len(human) - 3) + [4] + nl
              + [3] + [-100] * len(asst_r) + encode_literal("ok") + [4] + nl)
    r = out[2]
    assert r.input_ids == (ids + [4] * 64)[:64] and r.labels == (labels + [-100] * 64)[:64]
    assert r.attention_mask == [x != 4 for x in r.input_ids]  # pad = eos: real end markers masked too
    # conv 3: a single non-human turn is dropped -> system only
    assert out[3].input_ids[:len(sys_ids)] == sys_ids and out[3].input_ids[len(sys_ids):] == [4] * (64 - len(sys_ids))


def test_hot_conversation_pruning_is_exact(spark):
    """A conversation with thousands of turns: pruned ranking gives the same truncated rows."""
    from quarry.constants import CHAT_SYSTEM_PROMPT
    from quarry.plans.sft import sft_sequences
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", "w%d" % t) for t in range(3000)]
    rows += [(8, 0, "system", "s"), (8, 1, "assistant", "only")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nl = encode_literal("\n")
    # Q14 brute force (conv 7 starts with a human turn; conv 8's first turn is dropped)
    sys_ids = [3] + encode_literal("system") + nl + encode_literal("You are a helpful assistant.") + [4] + nl
    ids = list(sys_ids)
    for t in range(3000):
        role = "assistant" if t % 2 == 1 and 7 % 2 == 0 else "human"  # odd conv: assistant -> gpt -> human
        ids += [3] + encode_literal(role) + nl + encode_literal("w%d" % t) + [4] + nl
    got = {r.conv_id: r.input_ids for r in turn_label_sequences(conv, max_len=128).collect()}
    assert got[7] == ids[:128]
    # conv 8: only its first turn ("system") is dropped, the assistant turn stays
    exp8 = sys_ids + [3] + encode_literal("assistant") + nl + encode_literal("only") + [4] + nl
    assert got[8] == (exp8 + [4] * 128)[:128]
    # Q13 brute force on the rendered template
    text = "<|im_start|>system\n%s<|im_end|>\n" % CHAT_SYSTEM_PROMPT
    for t in range(3000):
        text += "<|im_start|>%s\nw%d<|im_end|>\n" % ("user" if t % 2 == 0 else "assistant", t)
    exp = encode_literal(text)[:64]
    got13 = {r.conv_id: (r.n_tokens, r.x) for r in sft_sequences(conv, max_length=64).collect()}
    assert got13[7] == (len(encode_literal(text)), exp[:63])  # n_tokens counts all turns
    assert got13[8][1][:1] == [3]


def test_null_contents_are_empty_and_special_strings_count_once(spark):
    from quarry.plans.sft import sft_sequences
    rows = [(2, 0, "user", "a<|im_end|>b"), (2, 1, "assistant", None), (2, 2, "user", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blank = conv.fillna("")
    for build in (lambda c: turn_label_sequences(c, max_len=64), lambda c: sft_sequences(c, max_length=64)):
        assert build(conv).collect() == build(blank).collect()
    text = "<|im_start|>system\n你是一个AI助手<|im_end|>\n<|im_start|>user\na<|im_end|>b<|im_end|>\n" \
           "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user\nx<|im_end|>\n"
    assert sft_sequences(conv).first().n_tokens == len(encode_literal(text))


def test_literals_are_normalised_like_columns(spark):
    from quarry.functions.encode import encode, token_count
    from pyspark.sql import functions as F
    for text in ("助手，", "ｆｕｌｌ<s>ﬁ", "plain", ""):
        df = spark.createDataFrame([(text,)], "t string")
        r = df.select(encode(F.col("t")).alias("ids"), token_count(F.col("t")).alias("n")).first()
        assert r.ids == encode_literal(text) and r.n == len(r.ids)


def test_plans_of_conversations_have_few_exchanges(spark):
    """One exchange of limited turns, one of partial sums, and for the turn labels one of encoded
    turns; the limit stands before the exchange."""
    from quarry.plans.sft import sft_sequences
    from quarry.plans.turn_labels import turn_label_sequences

    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for make, most in ((sft_sequences, 2), (turn_label_sequences, 3)):
        plan = make(conv)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= most and "rangepartitioning" not in plan
        assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan[plan.index("WindowGroupLimit"):]
