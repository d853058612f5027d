"""Nested access, higher-order array helpers and projection helpers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _path(col: Column, path: str) -> Column:
    for part in path.split("."):
        col = col.getField(part)
    return col


def pluck(arr, path: str) -> Column:
    """Field (or ``a.b`` path) of every struct of an array -> array of values.

    A NULL array stays NULL, an empty array stays empty and an element without
    the field gives a NULL element (GetArrayStructFields semantics).
    """
    return _path(_c(arr), path)


def pluck_where(arr, pred: Callable[[Column], Column], path: str) -> Column:
    """Keep array elements matching ``pred`` (a lambda on the element), then pluck."""
    return _path(F.filter(_c(arr), pred), path)


def first_where(arr, pred: Callable[[Column], Column], path: str, cast: str | None = None) -> Column:
    """First element matching ``pred``, its field at ``path``; NULL when none.

    ``get`` returns NULL out of range (no ANSI error) and ``try_cast`` turns a
    malformed value into NULL.
    """
    value = _path(F.get(F.filter(_c(arr), pred), 0), path)
    return value.try_cast(cast) if cast else value


def arr_or_empty(col, element_type: str = "string") -> Column:
    """NULL array -> typed empty array."""
    return F.coalesce(_c(col), F.array().cast(f"array<{element_type}>"))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``na.fill`` restricted to columns that exist (unknown names are skipped)."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.na.fill(present) if present else df


def select_as(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Project to a target schema: ``{out_name: column | name | (column, type)}``.

    A ``(column, type)`` pair is cast leniently with ``try_cast``.
    """
    cols = []
    for name, spec in mapping.items():
        if isinstance(spec, tuple):
            col, type_name = spec
            cols.append(_c(col).try_cast(type_name).alias(name))
        else:
            cols.append(_c(spec).alias(name))
    return df.select(*cols)
