"""Fixed values.

These must equal the values the training code expects (special tokens and
their ids, chat template pieces, default system prompts, loop intervals).
They are stated here once, in natural order, and used everywhere else.
"""

# --- fixed values: special tokens, in id order (ids 0..4) -------------------
SPECIAL_TOKENS = ["<unk>", "<s>", "</s>", "<|im_start|>", "<|im_end|>"]
UNK_ID = 0
IM_START_ID = 3  # bos
IM_END_ID = 4  # eos, also the pad id
BOS_TOKEN = "<|im_start|>"
EOS_TOKEN = "<|im_end|>"
BOS_ID = IM_START_ID
EOS_ID = IM_END_ID
PAD_ID = IM_END_ID
IGNORE_INDEX = -100  # label value skipped by the turn-label path
LOSS_IGNORE_ID = 0  # target id whose loss is zeroed (cross entropy ignore_index)

# --- fixed values: chat template ---------------------------------------------
TEMPLATE_ROLES = ["system", "user", "assistant"]
GENERATION_PROMPT = "<|im_start|>assistant\n"
ASSISTANT_HEADER = "<|im_start|>assistant\n"
CHAT_SYSTEM_PROMPT = "你是一个AI助手"  # conversion of raw conversations (chat SFT path)
TURN_SYSTEM_PROMPT = "You are a helpful assistant."  # turn-label SFT path
TURN_ROLE_HUMAN = "human"
TURN_ROLE_ASSISTANT = "assistant"

# --- fixed values: byte-level pre-tokenizer (GPT-2 split, Java needs (?U)) ---
PRETOKEN_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# --- fixed values: defaults of the data path ---------------------------------
CHUNK_SIZE = 512  # characters per pretraining chunk
MAX_LENGTH = 512  # token ids per padded sequence (pretrain, chat SFT)
TURN_MAX_LENGTH = 2048  # turn-label SFT
BLOCK_SIZE = 2048  # packed block
PACK_BATCH_SIZE = 1000  # rows per packing batch (map default)
HEAD_RECORDS = 10000  # turn-label SFT reads the first 10,000 records
VOCAB_SIZE = 6144
MIN_FREQUENCY = 2
BATCH_SIZE = 64
ACCUMULATION_STEPS = 8
LOG_INTERVAL = 100
SAVE_INTERVAL = 1000
SNAPSHOT_INTERVAL = 20000
LEARNING_RATE = 2e-4
MIN_LR_DIVISOR = 10
SEED = 42
