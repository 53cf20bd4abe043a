"""Column-expression helpers. All of them compile to built-in Catalyst
expressions, so they stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
MICROS_PER_DAY = 86_400_000_000

# The coordinate box used to drop bad geolocation points
# (latitude -34 .. 5.5, longitude -74 .. -34).
LAT_BOX = (-34.0, 5.5)
LNG_BOX = (-74.0, -34.0)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance; null in, null out (PRJ-1)."""
    la1, lo1, la2, lo2 = (F.radians(col(c)) for c in (lat1, lng1, lat2, lng2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def micros(ts) -> Column:
    """Epoch microseconds of a timestamp (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def epoch_seconds(ts) -> Column:
    """PRJ-23: epoch seconds as double."""
    return micros(ts) / F.lit(1e6)


def add_seconds(ts, seconds) -> Column:
    """Timestamp plus a (whole or fractional) number of seconds, exact to the microsecond."""
    return F.timestamp_micros(micros(ts) + (col(seconds).cast("double") * F.lit(1e6)).cast("long"))


def floor_days(later, earlier) -> Column:
    """PRJ-7: whole days between two timestamps, floored toward minus infinity
    (half a day early is -1). ``datediff`` would count calendar boundaries."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_DAY)))


def frac_days(later, earlier) -> Column:
    """PRJ-8: fractional days between two timestamps."""
    return (micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_DAY))


def late_flag(days_late) -> Column:
    """PRJ-9: late when whole days late > 0; an undated order is not late."""
    return F.coalesce(col(days_late) > 0, F.lit(False))


def ratio(num, den) -> Column:
    """PRJ-4: num / den with a zero or null denominator giving null."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def nan_max(a, b) -> Column:
    """NumPy ``maximum``: null when either side is null (``greatest`` skips nulls)."""
    a, b = col(a), col(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.greatest(a, b))


def clip(x, lo=None, hi=None) -> Column:
    """PRJ-15: clip to [lo, hi]; null stays null."""
    x = col(x)
    out = x
    if lo is not None:
        out = F.when(out.isNull(), None).otherwise(F.greatest(out, F.lit(lo) if not isinstance(lo, Column) else lo))
    if hi is not None:
        out = F.when(out.isNull(), None).otherwise(F.least(out, F.lit(hi) if not isinstance(hi, Column) else hi))
    return out


def cut(x, edges: Sequence[float], labels: Sequence[str] | None = None, right: bool = True) -> Column:
    """PRJ-12/13: band a numeric by fixed edges like ``pd.cut``.

    ``right=True`` gives (a, b] bands, ``right=False`` gives [a, b).  Values
    outside the outer edges (and nulls) map to null.  Edges may be Columns
    (data-driven outer edges) or numbers; ``math.inf`` is allowed.
    """
    x = col(x)
    if labels is None:
        labels = [str(i) for i in range(len(edges) - 1)]
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
        hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
        if right:
            cond = (x > lo_c) & (x <= hi_c)
        else:
            cond = (x >= lo_c) & (x < hi_c)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def band_order(x, edges: Sequence[float], right: bool = True) -> Column:
    """Integer position of the band chosen by :func:`cut` (0-based), for ordering."""
    return cut(x, edges, [str(i) for i in range(len(edges) - 1)], right).cast("int")


def r(x, digits: int) -> Column:
    """PRJ-20: round half to even the way NumPy / pandas ``round`` do: scale the
    double by 10^d, round the scaled binary value half to even, scale back.

    Every step is plain IEEE arithmetic, so the DuckDB oracle (which expands
    ``round_even`` to the same formula) gets bit-identical results, which
    ``bround`` (decimal-string rounding) does not guarantee on ties."""
    scale = float(10 ** digits)
    y = col(x).cast("double") * F.lit(scale)
    f = F.floor(y)
    frac = y - f
    rounded = (F.when(frac > 0.5, f + 1).when(frac < 0.5, f).otherwise(f + F.pmod(f, F.lit(2))))
    return rounded / F.lit(scale)


def fixed_round(x, digits: int) -> Column:
    """Half-up rounding by plain double arithmetic (floor(x*10^d + .5)/10^d).

    Used where two engines must produce bit-identical values (fixture views)."""
    scale = float(10 ** digits)
    return F.floor(col(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def log1p_target(x) -> Column:
    return F.log1p(col(x))


def expm1_floor0(x) -> Column:
    """PRJ-11: back-transform of a log1p prediction, floored at zero."""
    return F.greatest(F.expm1(col(x)), F.lit(0.0))


def inf(sign: int = 1) -> float:
    return math.inf if sign > 0 else -math.inf
