"""Q12: pretraining sequences: BOS + text -> ids -> truncate -> pad -> mask -> shift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.constants import BOS_ID, MAX_LENGTH, PAD_ID
from quarry.functions.arrays import length_mask
from quarry.functions.encode import BpeModel
from quarry.functions.idbytes import encode_packed, n_ids, pad_right, prepend, shift_x, shift_y, unpack_ids


def pretrain_sequences(df: DataFrame, model: BpeModel | None = None, max_length: int = MAX_LENGTH,
                       text_col: str = "text", keep: list[str] | None = None,
                       pad: int = PAD_ID, normalize: bool = True) -> DataFrame:
    """Rows (keep..., n_tokens, x, y, loss_mask); x/y/mask have width max_length-1.

    One narrow stage: no shuffle.  ``n_tokens`` is the length before truncation.  Ids are a binary
    column up to the end (``idbytes``).
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    # encode(BOS + text) == [bos] + encode(text): the special is always split off first
    ids = df.select(*keep, prepend(BOS_ID, encode_packed(F.col(text_col), model, normalize)).alias("_ids"))
    padded = ids.select(*keep, n_ids(F.col("_ids")).alias("n_tokens"), pad_right(F.col("_ids"), max_length, pad).alias("_p"))
    # a shifted length mask is the mask of one position less
    return padded.select(*keep, "n_tokens", unpack_ids(shift_x(F.col("_p"), max_length)).alias("x"),
                         unpack_ids(shift_y(F.col("_p"), max_length)).alias("y"),
                         length_mask(F.col("n_tokens") - 1, max_length - 1).alias("loss_mask"))
