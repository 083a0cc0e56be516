"""Dictionary recodes and bucketing."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode(c, mapping: dict, default=None, keep_unmapped: bool = True) -> Column:
    """Map values through ``mapping``.

    Unmapped values are kept as they are (``keep_unmapped``) or replaced by
    ``default``.  The map is a literal, evaluated inside whole-stage codegen.
    """
    looked = F.try_element_at(_map_literal(mapping), _c(c))
    fallback = _c(c) if keep_unmapped else F.lit(default)
    return F.coalesce(looked, fallback)


def ordinal(c, levels: list, default=None) -> Column:
    """Position of a value in an ordered level list (NULL or default outside)."""
    looked = F.try_element_at(_map_literal({v: i for i, v in enumerate(levels)}), _c(c))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def bucket(c, edges: list[tuple], labels: list[str]) -> Column:
    """label by half-open ``(lo, hi]`` intervals; NULL outside all.

    ``edges`` holds ``(lo, hi)`` pairs; ``None`` means unbounded.
    """
    c = _c(c)
    out = None
    for (lo, hi), label in zip(edges, labels):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c > lo)
        if hi is not None:
            cond = cond & (c <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out
