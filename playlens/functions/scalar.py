"""Scalar column expressions (parsing, keys, scores).

Each helper returns a native Spark ``Column``; nothing runs Python per row.
Lenient parsing uses ``try_*`` functions so results do not depend on the
session's ANSI setting: malformed input gives NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ts(col) -> Column:
    """Epoch seconds -> TIMESTAMP, without a round trip through local text."""
    return F.timestamp_seconds(_c(col))


def safe_date(col, fmt: str | None = None) -> Column:
    """String -> DATE, NULL when malformed (e.g. ``2024-02-30`` or ``''``)."""
    return F.try_to_date(_c(col)) if fmt is None else F.try_to_date(_c(col), F.lit(fmt))


def safe_ts(col, fmt: str | None = None) -> Column:
    """String -> TIMESTAMP, NULL when malformed."""
    return F.try_to_timestamp(_c(col)) if fmt is None else F.try_to_timestamp(_c(col), F.lit(fmt))


def safe_cast(col, type_name: str) -> Column:
    """Cast that yields NULL instead of failing (bad text, overflow)."""
    return _c(col).try_cast(type_name)


def release_year(col) -> Column:
    return F.year(_c(col))


def link_key(col, empty_as_null: bool = True) -> Column:
    """Lower-case and keep only ``[a-z0-9]``; the join key for catalogue links.

    A title with no such character would map to ``''`` and link every such
    title of a year together, so by default ``''`` becomes NULL (no link).
    """
    key = F.regexp_replace(F.lower(_c(col)), r"[^a-z0-9]", "")
    return F.nullif(key, F.lit("")) if empty_as_null else key


def slug(col) -> Column:
    """Tag slug: lower-case, every other character to ``_``, runs collapsed."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(col)), r"[^a-z0-9]", "_"), r"_{2,}", "_")


def unify_tags(*cols) -> Column:
    """Distinct union of several (possibly NULL) string arrays."""
    parts = [F.coalesce(_c(c), F.array().cast("array<string>")) for c in cols]
    return F.array_distinct(F.concat(*parts))


def affinity(playtime, avg_playtime) -> Column:
    """Implicit preference ``log1p(x / avg)``; NULL when avg is 0 or NULL."""
    return F.log1p(F.try_divide(_c(playtime), _c(avg_playtime)))


def cohort_item_score(cohort_score, global_score, exponent: float = 1.2) -> Column:
    """``pow(s, p) / log1p(g)``: cohort affinity damped by global popularity."""
    return F.try_divide(F.pow(_c(cohort_score), F.lit(exponent)), F.log1p(_c(global_score)))


def jaccard(inter, size_a, size_b) -> Column:
    """``i / (a + b - i)``; NULL when the denominator is 0."""
    i = _c(inter)
    return F.try_divide(i.cast("double"), (_c(size_a) + _c(size_b) - i).cast("double"))


def lift(share, base_share) -> Column:
    return F.try_divide(_c(share), _c(base_share))
