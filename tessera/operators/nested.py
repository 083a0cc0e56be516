"""Nested documents -> flat columns.

``flatten`` walks the schema, not the rows: struct fields become
``parent_child`` columns and array positions become ``parent_<i>_child``
columns read with ``get`` (NULL past the end, where ``arr[i]`` would raise
under ANSI).  How many positions an array needs is the only data-dependent
part; one aggregate pass returns the maximum size of every array path as a
single row.  Everything else is one ``select`` evaluated inside whole-stage
codegen -- no Python per row.

Columns with open keys (VARIANT, or maps) have no schema to walk: one
aggregate first returns the union of the keys found and their types
(``key_types``), and the columns are read by it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: In the text of a variant's type: a quoted key, or a word that a schema spells otherwise.
_SPELLED = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bVOID\b")


def has_open_keys(dtype: DataType) -> bool:
    """Whether keys below ``dtype`` come from the rows instead of the schema."""
    if isinstance(dtype, StructType):
        return any(has_open_keys(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return has_open_keys(dtype.elementType)
    return isinstance(dtype, (MapType, VariantType))


def _as_variant(df: DataFrame, c: str) -> Column:
    e = F.col(f"`{c}`")
    return e if isinstance(df.schema[c].dataType, VariantType) else F.to_variant_object(e)


def key_types(df: DataFrame, cols: list[str]) -> dict[str, DataType]:
    """A5: the union of the keys found in each open column, as a type.

    One aggregation over the rows (schemas are merged in every task, then
    across tasks; the result has one entry per key).  A key that holds numbers of
    several kinds gets the wider one; one that holds values of different kinds
    stays a VARIANT; one that only ever is null becomes a string.
    """
    row = df.agg(*[F.schema_of_variant_agg(_as_variant(df, c)).alias(f"t{i}") for i, c in enumerate(cols)]).first()
    spell = {"OBJECT<": "STRUCT<", "VOID": "STRING"}
    return {c: DataType.fromDDL(_SPELLED.sub(lambda m: spell.get(m[0], m[0]), t)) for c, t in zip(cols, row)}


def with_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """A5: the open columns ``cols`` as structs of all keys found (NULL where a
    row lacks one).  Keys that differ in case only cannot both be columns."""
    types = key_types(df, cols)

    def check(t: DataType) -> None:
        if isinstance(t, ArrayType):
            return check(t.elementType)
        if isinstance(t, StructType):
            names = [f.name.lower() for f in t.fields]
            if dup := sorted({n for n in names if names.count(n) > 1}):
                raise ValueError(f"keys {dup} differ in case only")
            for f in t.fields:
                check(f.dataType)

    for t in types.values():
        check(t)
    typed = {c: F.variant_get(_as_variant(df, c), "$", _ddl(t)).alias(c) for c, t in types.items()}
    return df.select(*[typed.get(c, F.col(f"`{c}`")) for c in df.columns])


def _ddl(t: DataType) -> str:
    """The type as DDL text, every key quoted."""
    if isinstance(t, StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in t.fields) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, ArrayType) else t.simpleString()


def _array_paths(dtype: DataType, path: tuple = ()) -> list[tuple]:
    """Schema paths of every array; ``'[]'`` marks a step into array elements."""
    out = []
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            out += _array_paths(f.dataType, path + (f.name,))
    elif isinstance(dtype, ArrayType):
        out.append(path)
        out += _array_paths(dtype.elementType, path + ("[]",))
    return out


def _sizes(e: Column, dtype: DataType, rest: tuple) -> Column:
    """array<int> with the sizes of all arrays found at ``rest`` below ``e``."""
    if not rest:
        return F.array(F.size(e))
    step = rest[0]
    if step == "[]":
        return F.flatten(F.transform(e, lambda x: _sizes(x, dtype.elementType, rest[1:])))
    field = dtype[step].dataType
    return _sizes(e.getField(step), field, rest[1:])


def array_sizes(df: DataFrame, cols: list[str]) -> dict[tuple, int]:
    """Maximum size of every array path under ``cols``: one bounded one-row pass."""
    exprs, keys = [], []
    for c in cols:
        dtype = df.schema[c].dataType
        for p in _array_paths(dtype):
            keys.append((c,) + p)
            exprs.append(F.max(F.array_max(_sizes(F.col(c), dtype, p))).alias(f"s{len(keys)}"))
    if not exprs:
        return {}
    row = df.agg(*exprs).first()
    return {k: int(row[i] or 0) for i, k in enumerate(keys)}


def _leaves(e: Column, dtype: DataType, name: str, path: tuple, sizes: dict, caps: dict):
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            yield from _leaves(e.getField(f.name), f.dataType, f"{name}{f.name}_", path + (f.name,), sizes, caps)
    elif isinstance(dtype, ArrayType):
        # "top" = the flattened column is itself an array (names start with
        # the position); every other array is "nested".
        cap = caps.get("top" if len(path) == 1 else "nested")
        n = sizes.get(path, 0 if cap is None else cap)
        if cap is not None:
            n = min(n, cap)
        for i in range(n):
            yield from _leaves(F.get(e, F.lit(i)), dtype.elementType, f"{name}{i}_", path + ("[]",),
                               sizes, caps)
    else:
        yield (name[:-1] or "blank"), e.cast("string") if isinstance(dtype, VariantType) else e


def flatten(df: DataFrame, cols: list[str], prefix: bool = False,
            top_positions: int | None = None, nested_positions: int | None = None) -> DataFrame:
    """``flatten(df, cols_to_flatten) -> df``.

    Root columns not in ``cols`` are kept; each listed column is replaced by
    its leaves.  Leaf name = field/position path joined by ``_``; the listed
    column's own name is left out unless ``prefix`` (so ``sales.public.x``
    becomes ``public_x``).  ``top_positions`` / ``nested_positions`` keep only
    the first positions of top-level / nested arrays (N2): the columns then
    follow from the schema and the caps alone, every kept position is a column
    (NULL where the array is shorter), and no pass over the data is made.
    Without a cap for one of the arrays, their sizes are read in one one-row
    pass.  Repeated output names raise instead of silently dropping every copy
    (D26).  VARIANT and map columns are read by the union of their keys first
    (``with_keys``, one pass); a leaf whose values are of different kinds is
    given as text.
    """
    open_ = [c for c in cols if has_open_keys(df.schema[c].dataType)]
    if open_:
        df = with_keys(df, open_)
    capped = top_positions is not None and nested_positions is not None
    sizes = {} if capped else array_sizes(df, cols)
    caps = {"top": top_positions, "nested": nested_positions}
    out: list[Column] = []
    names: list[str] = []
    keep = [c for c in df.columns if c not in cols]
    for c in keep:
        out.append(F.col(f"`{c}`"))
        names.append(c)
    for c in cols:
        dtype = df.schema[c].dataType
        base = f"{c}_" if prefix else ""
        if not isinstance(dtype, (StructType, ArrayType)):
            out.append(F.col(f"`{c}`").cast("string").alias(c) if isinstance(dtype, VariantType) else F.col(f"`{c}`"))
            names.append(c)
            continue
        for leaf, e in _leaves(F.col(f"`{c}`"), dtype, base, (c,), sizes, caps):
            out.append(e.alias(leaf))
            names.append(leaf)
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"flatten would repeat column names {dup}; use prefix=True")
    return df.select(*out)
