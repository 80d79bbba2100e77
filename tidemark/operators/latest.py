"""Top-1 per key (``row_number() = 1``) with a deterministic order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _key(k) -> Column:
    return F.col(k) if isinstance(k, str) else k


def latest_per(df: DataFrame, keys: Sequence, order: Sequence) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order`` (each DESC NULLS LAST).

    Later ``order`` entries break ties of earlier ones; give enough of them to make the
    order total. The ``row_number() = 1`` form is planned as a partial
    ``WindowGroupLimit`` before the exchange, so every map task forwards at most one
    row per key: a hot key costs one row per task in the shuffle, not all its rows.
    """
    w = Window.partitionBy(*[_key(k) for k in keys]).orderBy(
        *[(_key(o)).desc_nulls_last() for o in order])
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
