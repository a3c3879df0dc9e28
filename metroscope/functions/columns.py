"""Scalar column helpers (X1-X6): all built-in expressions, codegen friendly, ANSI safe."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_timestamp(c: Column) -> Column:
    """Text or timestamp -> TimestampType; empty, blank or unparsable text -> null.

    ``try_to_timestamp`` keeps ANSI mode from failing the job on bad input.
    Typed input goes through the same expression (the string form of a timestamp parses back).
    """
    return F.try_to_timestamp(F.nullif(F.trim(c.cast("string")), F.lit("")))


def timestamp_of(df: DataFrame, name: str) -> Column:
    """Like ``parse_timestamp`` but skips the text round trip when the column is typed."""
    dt = df.schema[name].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return parse_timestamp(F.col(name))


def rnd(c: Column, digits: int = 0) -> Column:
    """Round half to even on the double scaled by 10^digits (``rint``) - numpy's and
    pandas' ``round``, and DuckDB's ``round_even``.

    Spark's ``round`` rounds the shortest decimal text half up instead (1.005 -> 1.01,
    13.25 -> 13.3), while the reference's Python/pandas rounding gives 1.0 and 13.2.
    The sign of zero is kept."""
    m = float(10 ** digits)
    return F.rint(c.cast("double") * F.lit(m)) / F.lit(m)


_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp splitting constant


def _split(v: float) -> tuple[float, float]:
    t = v * _SPLIT
    hi = t - (t - v)
    return hi, v - hi


def pyround(c: Column, digits: int = 0) -> Column:
    """Python's ``round(x, digits)``: half to even on the *exact* binary value.

    ``x * 10^d`` is computed in doubles and its exact rounding error is recovered with
    Dekker's two-product (Veltkamp splitting, plain double arithmetic). Only when the
    product lands exactly on a .5 does the error decide the direction (27.85 is stored
    just above the midpoint -> 27.9; 2.675 just below -> 2.67; 13.25 is exact -> 13.2).
    Same arithmetic in every engine, so the DuckDB oracle restates it."""
    m = float(10 ** digits)
    mh, ml = _split(m)
    x = c.cast("double")
    p = x * F.lit(m)
    t = x * F.lit(_SPLIT)
    xh = t - (t - x)
    xl = x - xh
    err = ((xh * F.lit(mh) - p) + xh * F.lit(ml) + xl * F.lit(mh)) + xl * F.lit(ml)
    fl = F.floor(p).cast("double")
    half = (p - fl) == F.lit(0.5)
    r = F.when(half & (err > 0), fl + 1).when(half & (err < 0), fl).otherwise(F.rint(p))
    return r / F.lit(m)


UNIT_DIGITS = 12  # fixed-point digits of exact means; real tones and hours need fewer


def to_units(c: Column) -> Column:
    """Fixed-point units (value x 10^12) as a wide decimal: sums of any number of rows are
    exact and cannot overflow."""
    return rnd(c.cast("double") * F.lit(10.0 ** UNIT_DIGITS), 0).cast("decimal(38,0)")


_LOW_BITS = 30


def sum_units(c: Column) -> Column:
    """Exact grouped sum of ``to_units`` (null without values). Values below 4.6 million are
    summed as two longs per row, high and low bits apart, and only the group's result
    becomes a wide decimal; larger ones are summed as wide decimals."""
    units = rnd(c.cast("double") * F.lit(10.0 ** UNIT_DIGITS), 0)
    narrow = F.abs(units) < F.lit(float(2 ** 62))
    whole = F.when(narrow, units.cast("long"))
    high, low = F.sum(F.shiftright(whole, _LOW_BITS)), F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    wide = F.sum(F.when(~narrow, units.cast("decimal(38,0)")))
    joined = high.cast("decimal(38,0)") * F.lit(1 << _LOW_BITS).cast("decimal(38,0)") + low.cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    return F.when(high.isNotNull() | wide.isNotNull(), F.coalesce(joined, zero) + F.coalesce(wide, zero)).cast("decimal(38,0)")


def exact_mean(units_sum: Column, n: Column, digits: int, python_round: bool = True) -> Column:
    """Mean of fixed-point values as one correctly rounded division of the exact sum, then
    rounded: the float mean a database AVG would hand back, rounded like the reference,
    but independent of summation order (so ties resolve the same in every engine and on
    every task retry). ``n = 0`` gives null. ``python_round`` picks Python's ``round`` (the
    reference's scalar code) over pandas' (``rnd``)."""
    mean = units_sum.cast("double") / (n.cast("double") * F.lit(10.0 ** UNIT_DIGITS))
    return F.when(n > 0, (pyround if python_round else rnd)(mean, digits))


def mean_rounded(c: Column, digits: int, over=None, python_round: bool = True) -> Column:
    """``round(avg(c), digits)`` computed exactly (see ``exact_mean``); works as a
    grouped aggregate or, with ``over``, as a window aggregate."""
    if over is None:
        s, n = sum_units(c), F.count(c)
    else:
        s, n = F.sum(to_units(c)).over(over), F.count(c).over(over)
    return exact_mean(s, n, digits, python_round)


def safe_ratio(num: Column, den: Column) -> Column:
    """A4: num / den, 0.0 when den is 0 (guarded, so ANSI never divides by zero)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def clip(c: Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    """Clamp into [lo, hi]; null stays null (``greatest``/``least`` alone skip nulls)."""
    return F.when(c.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), c)))


def ordinal(c: Column, pairs) -> Column:
    """Dictionary lookup with default 0 (a literal map, ``try_element_at`` is null-safe)."""
    m = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    return F.coalesce(F.try_element_at(m, c), F.lit(0))


def falsy_or(*cols: Column) -> Column:
    """Python ``a or b or c`` over text: '' and null both fall through; last operand is returned as is."""
    *head, last = cols
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)


def to_ntz(c: Column) -> Column:
    """Result edge: timestamps leave as ``timestamp_ntz`` (UTC wall clock)."""
    return c.cast("timestamp_ntz")
