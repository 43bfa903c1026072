"""Seeded numbers from keys: reproducible, free of overflow for any key, the same in plain SQL."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

FACTOR = 2654435761
DIGEST_DIGITS = 15


def residue(key: Column, seed: int, modulus: int) -> Column:
    """(key * FACTOR + seed) modulo a small modulus. The key is reduced first, so nothing overflows."""
    small = F.pmod(key.cast("long"), F.lit(modulus).cast("long"))
    return F.pmod(small * F.lit(FACTOR) + F.lit(seed), F.lit(modulus))


def digest(*parts: Column | int) -> Column:
    """Digest of the parts, joined by colons, in lower-case hex digits."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])
    return F.md5(text.cast("binary"))


def digest_number(*parts: Column | int) -> Column:
    """Uniform whole number of 60 bits from a digest of the parts, joined by colons."""
    return F.conv(F.substring(digest(*parts), 1, DIGEST_DIGITS), 16, 10).cast("long")


def digest_sql(*parts: str) -> str:
    """SQL of ``digest_number`` for the same parts."""
    text = ", ".join(f"({p})::VARCHAR" for p in parts)
    return f"('0x' || substr(md5(concat_ws(':', {text})), 1, {DIGEST_DIGITS}))::BIGINT"


# Rounds of the permutation, and how often a number may fall outside and be permuted again. A number falls
# outside with a probability below 1 / sqrt(n), so the bound is never reached.
PERMUTE_ROUNDS = 4
WALKS = 64


def permute_sides(n: int) -> tuple[int, int]:
    """A rectangle of at least n cells, less than a column too large."""
    a = max(math.isqrt(max(n - 1, 0)) + 1, 1)
    return a, max(-(-n // a), 1)


def permuted(index: Column, n: int, seed: int) -> Column:
    """A keyed permutation of 0..n-1, computed for each number alone.

    A number is a cell (l, r) of an a x b rectangle. Rounds add a digest of one coordinate to the other, in
    turn, which can always be undone. A cell behind the last number is permuted again until it is in front.
    """
    a, b = permute_sides(n)

    def once(cell: Column) -> Column:
        start = F.struct(_whole(cell, b).alias("l"), F.pmod(cell, F.lit(b).cast("long")).alias("r"))

        def turn(s: Column, k: Column) -> Column:
            even = k % 2 == 0
            left = F.when(even, F.pmod(s["l"] + digest_number(F.lit(seed), k, s["r"]), F.lit(a).cast("long"))).otherwise(s["l"])
            right = F.when(even, s["r"]).otherwise(
                F.pmod(s["r"] + digest_number(F.lit(seed), k, s["l"]), F.lit(b).cast("long"))
            )
            return F.struct(left.alias("l"), right.alias("r"))

        turns = F.sequence(F.lit(0), F.lit(PERMUTE_ROUNDS - 1))
        return F.aggregate(turns, start, turn, lambda s: s["l"] * b + s["r"])

    walk = F.sequence(F.lit(1), F.lit(WALKS))
    return F.aggregate(walk, once(index.cast("long")), lambda x, _: F.when(x >= n, once(x)).otherwise(x))


def _whole(number: Column, divisor: int) -> Column:
    """Whole-number quotient."""
    return F.call_function("div", number, F.lit(divisor).cast("long"))
