"""Column-name rules (B3-B7, D26, D27).  These look at the schema only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename listed columns, keep the rest."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_by_rule(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace every occurrence of a literal substring in column names.  A
    leading digit of ``old`` has to start a number (``0_`` is not found in ``10_``)."""
    rx = re.compile(("(?<![0-9])" if old[:1].isdigit() else "") + re.escape(old))
    return df.toDF(*[rx.sub(lambda _: new, c) for c in df.columns])


def drop_by_regex(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose name contains a match of ``pattern`` (search)."""
    rx = re.compile(pattern)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not rx.search(c)])


def drop_listed(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """Drop the listed columns; missing ones are ignored and reported."""
    missing = [n for n in names if n not in df.columns]
    return df.drop(*[n for n in names if n in df.columns]), missing


def repair_names(df: DataFrame) -> DataFrame:
    """Blank name -> ``blank``; repeated names raise (no silent loss)."""
    names = ["blank" if c == "" else c for c in df.columns]
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"repeated column names {dup}")
    return df.toDF(*names)
