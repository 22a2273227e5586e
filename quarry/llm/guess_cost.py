"""Guess cost of a password by dynamic programming over its segmentations, in bits.

A value is cut into segments, each a dictionary word, a date, a repeat, a walk over
the keyboard (or along the alphabet or digits) or a span that is tried by brute force.
A segment costs the choice of its kind and the bits of its own guesses; the cost of the value is the
least sum over all segmentations.  All lengths are code points.
"""

from __future__ import annotations

import math
import re

KIND = math.log2(5)
#: fixed values: rows of a US keyboard, plain and with shift; each row lies half a key to the right of the one above
ROWS = ["`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./"]
SHIFTED = ["~!@#$%^&*()_+", " QWERTYUIOP{}|", " ASDFGHJKL:\"", " ZXCVBNM<>?"]
KEYS = {c: (r, i, k) for k, rows in enumerate((ROWS, SHIFTED)) for r, row in enumerate(rows) for i, c in enumerate(row) if c != " "}
NEIGHBOURS = {(0, 1), (0, -1), (-1, 0), (-1, 1), (1, 0), (1, -1)}
#: fixed values: signs that stand for letters
LEET = dict(zip("@4031$5!7", "aaolessit"))
_DATE = re.compile(r"(\d{1,4})([-/._])(\d{1,2})\2(\d{1,4})")
_CENTURY = 2000


def plain_letters(value: str) -> str:
    """A-Z lower-cased, signs that stand for letters replaced; one character for each of ``value``."""
    return "".join(LEET.get(c, c.lower() if "A" <= c <= "Z" else c) for c in value)


def word_bits(written: str, rank_bits: float) -> float:
    """A word of the given rank as ``written``: capitals and signs for letters cost extra."""
    upper = sum(c.isupper() for c in written)
    lower = sum(c.islower() for c in written)
    case = 0.0
    if upper:
        case = 1.0 if not lower or (upper == 1 and written[0].isupper()) else math.log2(math.comb(upper + lower, min(upper, lower))) + 1
    return rank_bits + case + sum(c in LEET for c in written)


def char_bits(c: str) -> float:
    if c in "0123456789":
        return math.log2(10)
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log2(26)
    return math.log2(33) if c < "\x80" else 10.0


def _year_bits(year: int) -> float:
    return math.log2(max(abs(year - _CENTURY), 20))


def date_bits(s: str) -> float | None:
    """Bits of ``s`` as a year or a date (day, month and year in usual orders); None if it is neither."""
    if s.isascii() and s.isdigit():
        if len(s) == 4:
            return _year_bits(int(s)) if 1900 <= int(s) < 2100 else None
        if len(s) == 6:
            parts, extra = [(s[:2], s[2:4], s[4:]), (s[4:], s[2:4], s[:2])], 0.0
        elif len(s) == 8:
            parts, extra = [(s[:2], s[2:4], s[4:]), (s[6:], s[4:6], s[:4])], 0.0
        else:
            return None
    elif s.isascii() and (m := _DATE.fullmatch(s)):
        parts, extra = [(m[1], m[3], m[4]), (m[4], m[3], m[1])], 2.0
    else:
        return None
    best = None
    for a, b, year in parts:
        if len(year) not in (2, 4) or len(a) > 2 or (len(year) == 4 and not 1900 <= int(year) < 2100):
            continue
        low, high = sorted((int(a), int(b)))
        if 1 <= low <= 12 and high <= 31:
            full = int(year) if len(year) == 4 else (2000 if int(year) < 50 else 1900) + int(year)
            bits = math.log2(366) + _year_bits(full) + extra
            best = bits if best is None else min(best, bits)
    return best


def walks(s: str):
    """(start, end, bits) of every walk of three characters or more."""
    n = len(s)
    for i in range(n - 2):
        turns, last, shifts, step = 0, None, 0, None
        keyboard = sequence = True
        for j in range(i + 1, n):
            a, b = KEYS.get(s[j - 1]), KEYS.get(s[j])
            move = (b[0] - a[0], b[1] - a[1]) if a and b else None
            if keyboard and move in NEIGHBOURS:
                turns += move != last
                last = move
                shifts += a[2] != b[2]
            else:
                keyboard = False
            gap = ord(s[j]) - ord(s[j - 1])
            step = gap if j == i + 1 else step
            sequence = sequence and gap == step and abs(gap) == 1 and s[j].isalnum() and s[j - 1].isalnum()
            if not keyboard and not sequence:
                break
            if j - i >= 2:
                size = math.log2(j - i + 1)
                if keyboard:
                    yield i, j + 1, math.log2(47) + size + turns * math.log2(6) + shifts
                if sequence:
                    yield i, j + 1, math.log2(26) + size + 1


def repeats(s: str):
    """(start, end, unit length) of every run of two or more equal units, three characters or more in all."""
    n = len(s)
    for p in range(1, n // 2 + 1):
        same = 0  # how many characters from i on equal the one p later
        runs = [0] * (n + 1)
        for i in range(n - p - 1, -1, -1):
            same = same + 1 if s[i] == s[i + p] else 0
            runs[i] = same
        for i in range(n - 2 * p + 1):
            for times in range(2, runs[i] // p + 2):
                if times * p > 2:
                    yield i, i + times * p, p


def guess_bits(value: str, words: list[tuple[int, int, float]], _memo: dict | None = None) -> float:
    """The least cost of ``value``; ``words`` are (start, end, rank bits) of its dictionary words.

    The empty value costs 0.
    """
    memo = {} if _memo is None else _memo
    if value in memo:
        return memo[value]
    n = len(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, rank in words:
        ends[j].append((i, word_bits(value[i:j], rank)))
    for i, j, bits in walks(value):
        ends[j].append((i, bits))
    for i in range(n - 3):
        for j in range(i + 4, min(i + 10, n) + 1):
            if (bits := date_bits(value[i:j])) is not None:
                ends[j].append((i, bits))
    for i, j, p in repeats(value):
        unit = value[i: i + p]
        inner = [(a - i, b - i, w) for a, b, w in words if i <= a and b <= i + p]
        ends[j].append((i, guess_bits(unit, inner, memo) + math.log2((j - i) // p)))
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for j in range(1, n + 1):
        brute[j] = min(brute[j - 1], best[j - 1] + KIND) + char_bits(value[j - 1])
        best[j] = min([brute[j], *(best[i] + KIND + bits for i, bits in ends[j])])
    memo[value] = best[n]
    return best[n]
