"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_nullsafe(*parts, sep: str | None = None) -> Column:
    """Concatenation that reads NULL as '' (``concat`` alone gives NULL).

    ``sep`` is placed between every pair of parts even when a part is NULL,
    which is what a ``CONCAT(a, ' ', b)`` with NULL-as-empty produces.
    """
    cols = [F.coalesce(_c(p), F.lit("")) for p in parts]
    if sep is not None:
        out = []
        for i, c in enumerate(cols):
            if i:
                out.append(F.lit(sep))
            out.append(c)
        cols = out
    return F.concat(*cols)


def first_item(c, sep: str = ",") -> Column:
    """first element of a delimited list ('' when the text starts with sep)."""
    return F.split(_c(c), sep, -1).getItem(0)


def sprint_key(c, prefix: str, collapse_double_blank: bool = True) -> Column:
    """sheet column label -> sprint key.

    Underscores become blanks; with ``collapse_double_blank`` every pair of
    blanks is then removed (``A___B`` -> ``A B``), and ``prefix`` is prepended.
    """
    out = F.replace(_c(c), F.lit("_"), F.lit(" "))
    if collapse_double_blank:
        out = F.replace(out, F.lit("  "), F.lit(""))
    return F.concat(F.lit(prefix), out)


def collated(c, collation: str = "UTF8_LCASE") -> Column:
    """compare/group under a collation (case-insensitive ``UTF8_LCASE``,
    trailing-blank-insensitive ``UTF8_BINARY_RTRIM``); binary is the default."""
    return F.collate(_c(c), collation)
