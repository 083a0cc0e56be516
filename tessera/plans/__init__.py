"""Analyses of the catalogue, composed from operators.

Each module exposes ``QUERIES`` (name -> callable(spark, base) -> DataFrame)
and ``ORACLE`` (name -> ANSI SQL over the same tables) for the checks.
"""
