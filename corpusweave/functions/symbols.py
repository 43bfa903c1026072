"""Token sequences as strings whose code points are the token ids.

The first 256 symbols are the byte values, so text becomes symbols by reading its UTF-8 bytes as
ISO-8859-1. Ids from 0xD800 up are moved past the surrogate range. Merging a pair is then a native
``replace``: left to right and without overlap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATE_START = 0xD800
SURROGATE_COUNT = 0x800
# Highest code point; no id reaches it, so it can stand between pieces.
SEPARATOR = "\U0010ffff"
MAX_ID = 0x10FFFF - SURROGATE_COUNT - 1


def symbol(token_id: int) -> str:
    """The character that stands for an id."""
    if not 0 <= token_id <= MAX_ID:
        raise ValueError(f"token id {token_id} has no symbol")
    return chr(token_id if token_id < SURROGATE_START else token_id + SURROGATE_COUNT)


def symbol_id(char: str) -> int:
    point = ord(char)
    return point if point < SURROGATE_START else point - SURROGATE_COUNT


def text_to_symbols(text: Column) -> Column:
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def code_point(char: Column) -> Column:
    return F.ascii(char)


def chars(text: Column) -> Column:
    """Code points of a text, one string each; an empty text gives an empty array."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def symbols_to_ids(symbols: Column) -> Column:
    return F.transform(
        chars(symbols),
        lambda c: F.when(
            F.ascii(c) >= SURROGATE_START + SURROGATE_COUNT, F.ascii(c) - SURROGATE_COUNT
        ).otherwise(F.ascii(c)),
    )


def literal_array(items: list[str], sep: str = SEPARATOR) -> Column:
    """A constant array from one literal, folded once by the optimizer."""
    if not items:
        return F.array().cast("array<string>")
    return F.split(F.lit(sep.join(items)), sep)


def bytes_to_text(binary: Column) -> Column:
    """Decode UTF-8, invalid sequences become U+FFFD."""
    return F.make_valid_utf8(binary.cast("string"))
