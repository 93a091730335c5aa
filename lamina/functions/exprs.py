"""Column expressions shared by the operators. All built-in, JVM-side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina import fixed

# Fixed labels used by the decoders and defaults (domain-neutral wording).
UNKNOWN = "Unknown"
NOT_INFORMED = "Not informed"
NOT_APPLICABLE = "Not applicable"
ALL_LABEL = "All"

OUTCOME_LABELS = {1: "Positive", 0: "Negative"}
PRESENCE_LABELS = {1: "Present", 0: "Absent"}
SEGMENT_LABELS = {1: "Federal", 2: "State", 3: "Municipal", 4: "Private"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int = fixed.DECIMALS) -> Column:
    """Round a double once, half away from zero on its shortest decimal form
    (so 1.005 gives 1.01, and 71.0049999999 gives 71.0)."""
    return F.round(col(c).cast("double"), digits)


def round_fine(c: str | Column, digits: int = 8) -> Column:
    """Rounding for derived doubles (z-scores, encodings): drops last-ulp noise."""
    return F.round(col(c).cast("decimal(38,12)"), digits).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; null when den is 0 or null (no ANSI error)."""
    return F.try_divide(col(num).cast("double"), col(den))


def percent(num: str | Column, den: str | Column, digits: int = fixed.DECIMALS) -> Column:
    return round_half_up(ratio(num, den) * F.lit(100), digits)


def decode(c: str | Column, mapping: Mapping, default: str = UNKNOWN) -> Column:
    """CASE c WHEN k THEN v ... ELSE default END; null falls to the default."""
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    k0, v0 = items[0]
    expr = F.when(col(c) == F.lit(k0), F.lit(v0))
    for k, v in items[1:]:
        expr = expr.when(col(c) == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def fill_code(c: str | Column, value: int = 0) -> Column:
    return F.coalesce(col(c), F.lit(value))


def fill_text(c: str | Column, label: str = NOT_INFORMED) -> Column:
    """Null or empty text -> label."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(label))


def threshold_flag(c: str | Column, threshold: float) -> Column:
    """1 when c >= threshold else 0 (null compares false -> 0)."""
    return F.when(col(c) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def risk_tier(score_pct: str | Column, high_below: float = fixed.RISK_HIGH_BELOW,
              low_from: float = fixed.RISK_LOW_FROM) -> Column:
    """Tier of a class-1 probability in percent: low probability = high risk."""
    s = col(score_pct)
    return (F.when(s < F.lit(high_below), F.lit("High"))
            .when((s >= F.lit(high_below)) & (s < F.lit(low_from)), F.lit("Medium"))
            .when(s >= F.lit(low_from), F.lit("Low"))
            .otherwise(F.lit("N/A")))
