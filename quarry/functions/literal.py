"""Encoding of short constant strings (headers, role names) once, on the driver."""

from __future__ import annotations

import unicodedata

import regex  # \p{L} classes for the pre-token pattern

from quarry.constants import PRETOKEN_PATTERN, SPECIAL_TOKENS
from quarry.functions.bytes import byte_to_id
from quarry.functions.encode import BpeModel, make_word_encoder


def encode_literal(text: str, model: BpeModel | None = None, normalize: bool = True) -> list[int]:
    """Same ids as ``functions.encode.encode`` for a constant string."""
    pieces, i = [], 0
    specials = sorted(SPECIAL_TOKENS, key=len, reverse=True)
    buf = ""
    while i < len(text):
        hit = next((s for s in specials if text.startswith(s, i)), None)
        if hit:
            if buf:
                pieces.append(buf)
                buf = ""
            pieces.append(hit)
            i += len(hit)
        else:
            buf += text[i]
            i += 1
    if buf:
        pieces.append(buf)
    ids: list[int] = []
    b2i = byte_to_id()
    enc = make_word_encoder(model.merges) if model is not None and model.merges else None
    for p in pieces:
        if p in SPECIAL_TOKENS:
            ids.append(SPECIAL_TOKENS.index(p))
            continue
        if normalize:
            p = unicodedata.normalize("NFKC", p)
        if enc is None:
            ids.extend(b2i[b] for b in p.encode("utf-8"))
        else:
            pat = PRETOKEN_PATTERN.replace("(?U)", "")
            for w in regex.findall(pat, p):
                ids.extend(enc(w))
    return ids
