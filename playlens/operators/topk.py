"""Per-group top-k, latest version per key and de-duplication.

All three are ``row_number() <= k`` over a window with a *total* order, kept
in exactly that shape so Catalyst inserts ``WindowGroupLimit`` both before
and after the exchange: every map task keeps only its local top-k per key,
so a key holding a third of all rows ships at most k rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, partition_by, order_by, k: int, rank_col: str | None = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group under ``order_by``.

    ``order_by`` must be a total order inside a group (append an id as the
    last key); otherwise ties are broken arbitrarily.  The rank column is
    kept under ``rank_col`` (dropped when ``None``).
    """
    name = rank_col or "__rank"
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def dedupe(df: DataFrame, keys: Sequence[str], order_by) -> DataFrame:
    """One row per key; the survivor is the first under ``order_by``.

    NULL keys form one group each, as in ``dropDuplicates``.
    """
    return top_k(df, list(keys), order_by, 1, rank_col=None)


def latest_per_key(df: DataFrame, keys: Sequence[str], version_col: str = "dt",
                   baseline_labels: Sequence[str] = ("initial",), tie_breaks=()) -> DataFrame:
    """Latest row per key by load label, newest first.

    Load labels compare as text (``'20240102' > '20240101'``).  Labels in
    ``baseline_labels`` (the bulk load) rank below every dated load, so a
    daily update wins over the initial snapshot; ``baseline_labels=()``
    gives plain text order, where ``'initial'`` beats every date.
    ``tie_breaks`` order rows within one load (e.g. ``updated_at`` desc, id).
    """
    # a discovered partition column of dates alone is a number: labels are text
    label = F.col(version_col).cast("string")
    order = []
    if baseline_labels:
        order.append(F.when(label.isin(list(baseline_labels)), F.lit(0))
                     .otherwise(F.lit(1)).desc())
    order.append(label.desc())
    order.extend(_cols(tie_breaks))
    return top_k(df, list(keys), order, 1, rank_col=None)
