"""Reproducible random draws.

A draw is a hash of (seed, stream, row key): it does not depend on how the
rows are partitioned, nor on which task or attempt computes it.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS_PER_HASH = 4
_SPAN = 2.0**32


def _digest(seed: int, stream: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{stream}:"), key.cast("string")).cast("binary"))


def draw(seed: int, stream: int, key: Column, slot: int = 0) -> Column:
    """Integer in [0, 2^32). One hash carries four independent slots."""
    if not 0 <= slot < DRAWS_PER_HASH:
        raise ValueError(f"slot must be below {DRAWS_PER_HASH}")
    word = F.substring(_digest(seed, stream, key), 8 * slot + 1, 8)
    return F.conv(word, 16, 10).cast("bigint")


def uniform(seed: int, stream: int, key: Column, slot: int = 0) -> Column:
    """Double in [0, 1)."""
    return draw(seed, stream, key, slot) / F.lit(_SPAN)


def draw_below(n: Column, seed: int, stream: int, key: Column) -> Column:
    """Integer in [0, n), all about equally likely for any n below 2^62.

    The part above 62 bits of a 62-bit draw times ``n``, put together from products
    of 31-bit halves, none of which overflows.
    """
    high, low = (F.shiftright(draw(seed, stream, key, slot), 1) for slot in (0, 1))
    n_high, n_low = F.shiftright(n, 31), n.bitwiseAND(F.lit((1 << 31) - 1))
    middle = high * n_low + low * n_high + F.shiftright(low * n_low, 31)
    return high * n_high + F.shiftright(middle, 31)


def pick(u: Column, choices) -> Column:
    """One of ``choices`` by a uniform draw; a dict maps choices to weights."""
    if not isinstance(choices, dict):
        values = [F.lit(v) for v in choices]
        index = F.floor(u * F.lit(len(values))).cast("int")
        return F.element_at(F.array(*values), index + F.lit(1))
    bounds = list(accumulate(choices.values()))
    names = list(choices)
    result = None
    for name, bound in zip(names[:-1], bounds[:-1]):
        below = u < F.lit(round(bound, 9))
        result = F.when(below, F.lit(name)) if result is None else result.when(below, F.lit(name))
    return result.otherwise(F.lit(names[-1]))
