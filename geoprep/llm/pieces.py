"""What operators 8 and 10 share: cutting a text into pre-tokens.

A text is encoded as ``▁`` + text with every space written ``▁`` (identity normaliser, dummy
prefix, nothing collapsed).  No piece of the vocabulary holds ``▁`` after another character
(``check_vocabulary`` makes sure), so no merge and no piece crosses the start of a run of
``▁``: the text's tokens are those of its pre-tokens, each a run of spaces with the word
behind it.
"""

from __future__ import annotations

import re

MARK = "▁"
_SPACED = re.compile(r" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without their first space (the dummy prefix stands for the first one)."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if text[0] != " " and text[-1] != " " and "  " not in text:
        return text.split(" ")
    return [m[1:] for m in _SPACED.findall(" " + text)]


def check_vocabulary(pieces) -> None:
    bad = next((p for p in pieces if MARK in p.lstrip(MARK)), None)
    if bad is not None:
        raise ValueError(f"piece {bad!r} crosses a word start; pre-tokens would not be independent")
