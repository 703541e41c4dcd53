"""Reusable column expressions (all JVM-side, codegen friendly).

Each helper that also appears in oracle SQL has a twin ``*_sql`` that renders
the same arithmetic as text, so the engine and the SQL check agree bit for bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def rnd(c, d: int = 2) -> Column:
    """Round half away from zero to ``d`` digits, once.

    A value just under a half-way point (5e-10, less for nine digits) counts as
    half-way, so that the last-bit noise of summation orders does not decide the digit. Above 2**52
    units of the last digit a double has no further digits to round; it is
    returned as it is, so sums of any size keep their value.
    """
    c = F.col(c) if isinstance(c, str) else c
    c = c.cast("double")
    units = F.abs(c) * F.lit(float(10 ** d))
    near = 5e-10 * 10 ** d if d < 9 else 1e-6
    whole = F.floor(units + F.lit(0.5 + near)) / F.lit(float(10 ** d))
    return F.when(units < F.lit(float(2 ** 52)), F.signum(c) * whole + F.lit(0.0)).otherwise(c)


def rnd_sql(expr: str, d: int = 2) -> str:
    """The same value by the other engine's own decimal rounding."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38, 9)), {d}) AS DOUBLE)"


def exact_sum(c) -> Column:
    """Sum of amounts in decimals of 12 digits after the point: the same whatever the order of the rows."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(30,12)")).cast("double")


def padded(c: Column, n: int) -> Column:
    """A number with leading zeros up to ``n`` digits; longer numbers keep all their digits."""
    t = c.cast("string")
    return F.when(F.length(t) < n, F.lpad(t, n, "0")).otherwise(t)


def padded_sql(expr: str, n: int) -> str:
    t = f"CAST({expr} AS VARCHAR)"
    return f"(repeat('0', GREATEST({n} - length({t}), 0)) || {t})"


def share(count_col="n", by: Sequence[str] = (), d: int = 2) -> Column:
    """``100 * n / sum(n) over (partition by ...)``, rounded.

    Used on already-aggregated frames only (a few rows per partition key).
    """
    c = F.col(count_col) if isinstance(count_col, str) else count_col
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return rnd(F.lit(100.0) * c / F.sum(c).over(w), d)


def share_sql(count_expr: str = "n", by: Sequence[str] = (), d: int = 2) -> str:
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return rnd_sql(f"100.0 * {count_expr} / SUM({count_expr}) OVER ({part})", d)


def rate(cond: Column, d: int = 2) -> Column:
    """Percentage of rows meeting ``cond`` (an aggregate)."""
    return rnd(F.lit(100.0) * F.sum(F.when(cond, 1).otherwise(0)) / F.count(F.lit(1)), d)


def rate_sql(cond: str, d: int = 2) -> str:
    return rnd_sql(f"100.0 * SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) / COUNT(*)", d)


def bucket(c, edges: Sequence[float], labels: Sequence[str], right_open: bool = True,
           otherwise: str | None = None) -> Column:
    """Ordered CASE: label i when c < edges[i] (or <= when not right_open).

    ``labels`` has one more entry than ``edges`` (the last bucket), unless
    ``otherwise`` is given to name it.
    """
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for e, lab in zip(edges, labels):
        cond = (c < e) if right_open else (c <= e)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    last = labels[len(edges)] if len(labels) > len(edges) else otherwise
    return expr.otherwise(F.lit(last)) if last is not None else expr


def bucket_sql(expr: str, edges: Sequence[float], labels: Sequence[str], right_open: bool = True,
               otherwise: str | None = None) -> str:
    op = "<" if right_open else "<="
    parts = [f"WHEN {expr} {op} {e} THEN '{lab}'" for e, lab in zip(edges, labels)]
    last = labels[len(edges)] if len(labels) > len(edges) else otherwise
    tail = f" ELSE '{last}'" if last is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"


# A draw hashes the key's text together with the salt: the whole key counts,
# and draws with different salts are independent of each other.
_DRAWS = float(16 ** 12)


def draw(key, salt: int = 0) -> Column:
    """Deterministic draw in [0, 1) from a key and a salt."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(k.cast("string"), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(_DRAWS)


def draw_sql(key: str, salt: int = 0) -> str:
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 12) AS BIGINT) / {_DRAWS})"


def try_div(a: Column, b: Column) -> Column:
    """a / b, null when b is 0 or null (ANSI-safe)."""
    return F.try_divide(a, b)


def epoch_us(c) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, independent of the session time zone.

    (Casting ``timestamp_ntz`` to ``timestamp`` would apply the session zone
    and its daylight-saving shifts.)
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c.cast("timestamp_ntz"))


def days_between(a, b) -> Column:
    """Fractional days from ``b`` to ``a`` (wall-clock difference / 86400 s, zone independent)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.timestamp_diff("MICROSECOND", b.cast("timestamp_ntz"), a.cast("timestamp_ntz")) / F.lit(86400e6)


def days_between_sql(a: str, b: str) -> str:
    return f"((epoch_us({a}) - epoch_us({b})) / 86400e6)"


def ts_or_null(c) -> Column:
    """Text timestamp that may be empty -> timestamp or null (ANSI-safe)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(F.nullif(F.trim(c.cast("string")), F.lit("")))
