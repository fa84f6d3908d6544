"""Unit conversions, guarded ratios and composite ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit factors.
KG_PER_TONNE = 1000
GRAMS_PER_KG = 1000
KG_PER_POUND = 0.453592


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    """NULL unless the denominator is above zero."""
    return F.when(denominator > 0, numerator / denominator)


def percent_of(part: Column, total: Column) -> Column:
    """Share in percent; 0 where the total is not above zero."""
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))


def pounds_per_mwh_to_kg_per_kwh(rate: Column) -> Column:
    return rate * KG_PER_POUND / 1000


def joined_id(*parts: Column) -> Column:
    """Parts joined by ``_``; one NULL part makes the whole id NULL (unlike concat_ws)."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("_"), part]
    return F.concat(*pieces)
