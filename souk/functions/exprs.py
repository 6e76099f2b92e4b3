"""Column helpers shared by the operators.

Numbers follow the SQL the reference is written in: money is DECIMAL, an
average of a DECIMAL or an integer is a DECIMAL with 4 more digits, and
ratios are computed in DECIMAL before ROUND (ROUND on doubles is not the
same in every engine: 1.005 -> 1.01 or 1.0).  Division by zero is avoided
with NULLIF, as ANSI mode raises on it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's literals) ----------------------
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
LIFECYCLE_ORDER = ["ACTIVE", "AT_RISK", "DORMANT"]
# -----------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(v) -> Column:
    """Exact decimal literal (a Python float would become a DOUBLE literal)."""
    return F.lit(Decimal(str(v)))


def ts_lit(value) -> Column:
    """TIMESTAMP_NTZ literal from a driver-side datetime (no time-zone shift)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def nullif(c, v) -> Column:
    c = col(c)
    return F.when(c == F.lit(v), F.lit(None)).otherwise(c)


def as_decimal(c, scale: int = 0, precision: int = 18) -> Column:
    return col(c).cast(f"decimal({precision},{scale})")


def round_to(c, digits: int) -> Column:
    return F.round(col(c), digits)


def avg_dec(c, digits: int = 2, in_scale: int | None = None) -> Column:
    """ROUND(AVG(x), d) with x as DECIMAL (integers first become DECIMAL(18,0))."""
    c = col(c)
    if in_scale is not None:
        c = c.cast(f"decimal(18,{in_scale})")
    return F.round(F.avg(c), digits)


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(num * 100.0 / NULLIF(den, 0), d) in DECIMAL arithmetic."""
    return F.round(col(num) * dec("100.0") / nullif(den, 0), digits)


def ratio(num, den, digits: int = 4) -> Column:
    """ROUND(num * 1.0 / NULLIF(den, 0), d) in DECIMAL arithmetic."""
    return F.round(col(num) * dec("1.0") / nullif(den, 0), digits)


def flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_if(cond: Column) -> Column:
    return F.sum(flag(cond)).cast("bigint")


def days_between(start, end) -> Column:
    """Calendar-day difference end - start (boundary count, not elapsed 24h periods)."""
    return F.datediff(col(end), col(start))


def weekday_name(ts) -> Column:
    return F.date_format(col(ts), "EEEE")


def year_month(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def month_index(ts) -> Column:
    """Months since year 0: differences give whole calendar months between month starts."""
    return F.year(col(ts)) * 12 + F.month(col(ts))


def field_position(c, values: list[str]) -> Column:
    """Position of c in a fixed list (1-based, 0 when absent), like MySQL FIELD()."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), col(c))


def bucketize(c, branches: list[tuple[Column, str]], default: str) -> Column:
    """Label from the first matching (condition, label); gaps between bounds fall to ``default``."""
    out = F.when(branches[0][0], F.lit(branches[0][1]))
    for cond, label in branches[1:]:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def total_over(c) -> Column:
    """SUM(x) OVER () for a small aggregated frame (tens of rows)."""
    from pyspark.sql import Window

    return F.sum(col(c)).over(Window.partitionBy())
