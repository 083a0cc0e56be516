"""Gathers ``QUERIES`` and ``ORACLE`` of every plan module."""

from __future__ import annotations

import importlib

from pyspark.sql import SparkSession

from tessera.session import apply_runtime_defaults

MODULES = ["sales", "cohorts", "status", "events", "titles", "rentals", "basics"]


def _modules():
    return [importlib.import_module(f"tessera.plans.{m}") for m in MODULES]


def _with_defaults(fn):
    def run(spark: SparkSession, base: str):
        apply_runtime_defaults(spark)
        return fn(spark, base)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict:
    out = {}
    for m in _modules():
        for k, fn in m.QUERIES.items():
            if k in out:
                raise ValueError(f"duplicate query {k}")
            out[k] = _with_defaults(fn)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _modules():
        out.update(getattr(m, "ORACLE", {}))
    return out
