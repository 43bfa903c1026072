"""Splitting text into pieces, with special tokens cut out or kept."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.patterns import GPT2_PATTERN


def java_pattern(pattern: str) -> str:
    return "(?U)" + pattern


def piece_array(text: Column, pattern: str | None = GPT2_PATTERN) -> Column:
    """Pieces of a text in order; without a pattern the text is one piece."""
    if pattern is None:
        return F.filter(F.array(text), lambda p: p != "")
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))


def special_alternation(specials: Iterable[str]) -> str:
    """Escaped alternation with longer tokens first, so the longest one wins."""
    ordered = sorted(specials, key=len, reverse=True)
    return "|".join(r"\Q" + s.replace(r"\E", r"\E\\E\Q") + r"\E" for s in ordered)


def ordinary_parts(text: Column, specials: Iterable[str]) -> Column:
    """Text between special tokens; the tokens themselves are dropped."""
    specials = list(specials)
    if not specials:
        return F.filter(F.array(text), lambda p: p != "")
    return F.filter(F.split(text, special_alternation(specials)), lambda p: p != "")


def training_pieces(
    text: Column, pattern: str | None = GPT2_PATTERN, specials: Iterable[str] = ()
) -> Column:
    """Pieces for merge training: special tokens are removed, pieces never cross them."""
    specials = list(specials)
    if not specials:
        return piece_array(text, pattern)
    return F.flatten(
        F.transform(ordinary_parts(text, specials), lambda part: piece_array(part, pattern))
    )


def encoding_pieces(
    text: Column,
    specials: Mapping[str, int],
    pattern: str | None = GPT2_PATTERN,
    allowed_special: str = "all",
) -> Column:
    """Ordered array of structs (piece, special_id); special_id is null for ordinary pieces.

    ``all`` keeps the special tokens as single ids. ``none`` removes them, because ordinary
    splitting cuts them out as well. ``none_raise`` fails when a special token occurs.
    """
    if allowed_special not in ("all", "none", "none_raise"):
        raise ValueError(f"special tokens are handled as all, none or none_raise, not {allowed_special!r}")

    def plain(parts: Column) -> Column:
        return F.transform(
            parts, lambda p: F.struct(p.alias("piece"), F.lit(None).cast("int").alias("special_id"))
        )

    if not specials:
        return plain(piece_array(text, pattern))
    alternation = special_alternation(specials)
    if allowed_special == "none":
        return plain(training_pieces(text, pattern, specials))
    if allowed_special == "none_raise":
        checked = F.when(
            text.rlike(alternation),
            F.raise_error(F.lit("special token found in text, but allowed_special is none_raise")),
        ).otherwise(text)
        return plain(training_pieces(checked, pattern, specials))
    ids = F.create_map(*[x for t, i in specials.items() for x in (F.lit(t), F.lit(i))])
    found = F.regexp_extract_all(text, F.lit(alternation), F.lit(0))
    # split gives one part more than there are tokens: part, token, part, token, ..., part
    woven = F.zip_with(
        F.split(text, alternation),
        found,
        lambda part, token: F.concat(
            plain(F.when(part == "", F.array().cast("array<string>")).otherwise(piece_array(part, pattern))),
            F.when(token.isNull(), F.array().cast("array<struct<piece:string,special_id:int>>")).otherwise(
                F.array(F.struct(token.alias("piece"), ids[token].alias("special_id")))
            ),
        ),
    )
    return F.flatten(woven)


def piece_counts(
    docs: DataFrame,
    text: str = "text",
    pattern: str | None = GPT2_PATTERN,
    specials: Iterable[str] = (),
    by: Iterable[str] = (),
) -> DataFrame:
    """Distinct pieces with their counts: one scan and one pre-aggregated shuffle."""
    by = list(by)
    pieces = docs.select(
        *by, F.explode(training_pieces(F.col(text), pattern, specials)).alias("piece")
    )
    return pieces.groupBy(*by, "piece").agg(F.count(F.lit(1)).alias("n"))


def require_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows with a usable text: NULL and empty are left out."""
    return docs.filter(F.col(text).isNotNull() & (F.col(text) != ""))


def quote_python(specials: Iterable[str]) -> str:
    """The same alternation in the dialect of the Python and RE2 engines."""
    return "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
