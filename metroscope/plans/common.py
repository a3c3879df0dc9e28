"""Result-edge helpers shared by the query catalog."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.functions.columns import rnd
from pyspark.sql import types as T


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Timestamps and dates leave as timestamp_ntz (dates at midnight: the given tables
    carry dates the same way, and both engines then hand back the same value type);
    doubles are rounded so engines compare equal."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.DateType)):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            c = rnd(c, digits) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0
        cols.append(c.alias(f.name))
    return df.select(*cols)
