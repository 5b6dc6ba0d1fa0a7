"""Seeded hash order: a shuffle that is the same on every engine and every partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(seed: int | str, *key: str | Column) -> Column:
    """md5 of ``seed:key1:key2...`` as 32 hex digits; a null part counts as ``\\N``, so it keeps its place."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def order_key(order: str | Sequence[str]) -> Column:
    """One comparable value for a single or composite order column."""
    names = as_list(order)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)
