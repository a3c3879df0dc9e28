"""Generic DataFrame building blocks shared by the daily operators."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine(keys: Sequence[str], spine: DataFrame | None, parts: Sequence[DataFrame]) -> DataFrame:
    """Left-join several keyed parts onto a spine in one exchange (no spine: full join).

    Each part holds at most one row per key (they are aggregates). Instead of a chain
    of joins (one shuffle each), every input is widened to the common column set,
    unioned and folded with ``max`` per key; keys absent from the spine are dropped.
    Partial aggregation runs before the shuffle, so a hot key costs one row per task.
    """
    keys = list(keys)
    cols: dict = {}
    for p in parts:
        for f in p.schema.fields:
            if f.name not in keys and f.name not in cols:
                cols[f.name] = f.dataType

    def widen(df: DataFrame, is_spine: bool) -> DataFrame:
        return df.select(
            *keys,
            *[(F.col(c) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in cols.items()],
            F.lit(is_spine).alias("_spine"),
        )

    if spine is None:
        u = reduce(DataFrame.unionByName, [widen(p, True) for p in parts])
        return u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])
    u = reduce(DataFrame.unionByName, [widen(spine, True)] + [widen(p, False) for p in parts])
    g = u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols], F.max("_spine").alias("_spine"))
    return g.filter(F.col("_spine")).drop("_spine")
