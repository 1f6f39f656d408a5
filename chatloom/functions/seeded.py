"""Reproducible random choice.

A draw is a pure function of ``(seed, salt, ids)``, so it does not depend on how rows
are spread over partitions, survives a task retry and can be recomputed in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 1 << 32


def digest32(text: Column) -> Column:
    """First eight hex digits of ``md5(text)`` as a BIGINT in [0, 2**32)."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def draw(seed: int, salt: str, *ids: Column) -> Column:
    return digest32(F.concat_ws(":", F.lit(f"{seed}:{salt}"), *[i.cast("string") for i in ids]))


def pick_index(n: int | Column, seed: int, salt: str, *ids: Column) -> Column:
    """Uniform 0-based index below ``n``."""
    return (draw(seed, salt, *ids) % n).cast("int")


def pick(options: Sequence[str] | Column, seed: int, salt: str, *ids: Column) -> Column:
    """Uniform choice from a literal list or an array column; an empty array gives null."""
    if isinstance(options, Column):
        return F.get(options, F.try_mod(draw(seed, salt, *ids), F.size(options).cast("bigint")).cast("int"))
    return F.get(F.array(*[F.lit(o) for o in options]), pick_index(len(options), seed, salt, *ids))


def flip(p: float, seed: int, salt: str, *ids: Column) -> Column:
    """True with probability ``p``."""
    return draw(seed, salt, *ids) < F.lit(int(p * DRAW_RANGE)).cast("bigint")
