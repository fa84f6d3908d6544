"""How measures are compared: on a grid, as the sum order of doubles differs by engine.

The grid is shifted by a fraction of its step. Values with few decimals would otherwise lie
exactly between two grid points, where the last bit of a sum decides the rounding.
"""

from __future__ import annotations


def digits(column: str) -> int:
    """Decimals that survive the rounding errors of a sum, by the size the measure reaches."""
    if "mtco2e" in column or column == "avg_monthly_emissions":
        return 7
    if column in ("cost_usd", "total_cost_usd"):
        return 4
    grams = "gco2eq" in column and "kgco2eq" not in column
    if not grams and ("per_kwh" in column or "per_dollar" in column):
        return 9
    return 5 if column.endswith("_kgco2e") else 6


def shift(column: str) -> float:
    return float(f"1.37e-{digits(column) + 1}")
