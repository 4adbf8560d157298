"""Tokenising expressions shared by word count and word search.

A token is a maximal run of the letters a-z after lower-casing; every other
character (digits, punctuation, accented letters) separates tokens.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token alphabet and its complement.
TOKEN_CHARS = "[a-z]"
SEPARATOR_RUN = "[^a-z]+"
WORD_PATTERN = re.compile(r"[a-z]+")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """``array<string>`` of the tokens of ``text`` (may hold empty strings at the ends).

    One regex split on runs of separators: equal, after dropping empty strings,
    to replacing each non-letter by a space and splitting on single spaces.
    """
    return F.split(F.lower(_col(text)), SEPARATOR_RUN)


def contains_word(text, word: str) -> Column:
    """True when ``word`` is one of the tokens of ``text``; null text gives null.

    A lookaround regex on the lower-cased text: no token array is built and the
    scan stops at the first hit.
    """
    word = check_word(word)
    return F.lower(_col(text)).rlike(f"(?<![a-z]){word}(?![a-z])")


def check_word(word: str) -> str:
    w = (word or "").lower()
    if not WORD_PATTERN.fullmatch(w):
        raise ValueError(f"search word must be letters a-z only, got {word!r}")
    return w
