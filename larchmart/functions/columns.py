"""Column-expression helpers shared by every model.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text used for a NULL part of a surrogate key, the separator
# between parts, and the timestamp rendering inside keys.
NULL_TOKEN = "<null>"
KEY_SEPARATOR = "-"
TS_KEY_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_text(c: Column | str) -> Column:
    """Render a timestamp with microseconds, identical in every engine."""
    return F.date_format(_col(c), TS_KEY_FORMAT)


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 hex over the natural-key parts, NULL-safe.

    ``concat_ws`` skips NULLs, so every part is coalesced to a token first;
    otherwise ``(a, NULL)`` and ``(NULL, a)`` would collide.
    """
    rendered = [F.coalesce(_col(p).cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *rendered))


def date_key(c: Column | str) -> Column:
    """Date or timestamp -> integer YYYYMMDD (NULL stays NULL)."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end``."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date"))


def bool_flag(condition: Column) -> Column:
    """Predicate -> non-null boolean (NULL predicate becomes false)."""
    return F.when(condition, F.lit(True)).otherwise(F.lit(False))


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL instead of raising on a zero denominator."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def pct(numerator: Column | str, denominator: Column | str, precision: int = 10) -> Column:
    """``numerator / denominator * 100`` rounded HALF_UP to 2 dp as decimal."""
    return F.round(safe_div(numerator, denominator) * F.lit(100), 2).cast(f"decimal({precision},2)")


def money(c: Column | str, precision: int = 12) -> Column:
    """Round HALF_UP to cents and fix the declared decimal precision."""
    return F.round(_col(c), 2).cast(f"decimal({precision},2)")


def _exact_div(x: Column, y: Column) -> Column:
    """Integer quotient of two non-negative integral decimals, exactly."""
    return ((x - F.pmod(x, y)) / y).cast("decimal(38,0)")


def quotient_half_up(n: Column, d: Column) -> Column:
    """``n / d`` rounded HALF_UP (ties away from zero) to an integer, exactly,
    for integral ``n`` and positive ``d``; NULL when ``d`` is 0 or NULL."""
    n = n.cast("decimal(38,0)")
    d = F.nullif(d, F.lit(0)).cast("decimal(38,0)")
    q = _exact_div(F.abs(n) * F.lit(2) + d, d * F.lit(2))
    return F.when(n < 0, -q).otherwise(q)


def avg_half_up(c: Column, in_scale: int, precision: int = 14) -> Column:
    """Average of a column holding ``in_scale`` decimals, rounded HALF_UP to
    2 dp without intermediate rounding (a plain ``avg`` on decimals rounds
    to 6 dp first, which can move a tie)."""
    units = F.sum((c * F.lit(10**in_scale)).cast("decimal(38,0)"))
    hundredths = quotient_half_up(units * F.lit(10 ** (2 - in_scale)), F.count(c))
    return (hundredths / F.lit(100)).cast(f"decimal({precision},2)")


def pct_exact(numerator: Column, denominator: Column, precision: int = 10) -> Column:
    """``numerator / denominator * 100`` for 2-dp decimals, HALF_UP to 2 dp,
    computed in integer cents so the result never depends on the scale
    Spark assigns to a decimal division of wide sums."""
    n = (numerator * F.lit(100)).cast("decimal(38,0)")
    d = (denominator * F.lit(100)).cast("decimal(38,0)")
    return (quotient_half_up(n * F.lit(10000), d) / F.lit(100)).cast(f"decimal({precision},2)")
