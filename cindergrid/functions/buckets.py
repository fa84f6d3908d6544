"""Named value scales and the expression that sorts a column into one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scale:
    """``labels[i]`` holds below ``bounds[i]``; the last label takes the rest and NULL."""

    bounds: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.bounds) + 1 or list(self.bounds) != sorted(self.bounds):
            raise ValueError("a scale needs ascending bounds and one label more than bounds")


# gCO2eq/kWh limits and labels.
INTENSITY = Scale((100, 250, 400, 600), ("Very Low", "Low", "Medium", "High", "Very High"))
WIDE_INTENSITY = Scale((100, 300, 500, 700), ("Very Low", "Low", "Medium", "High", "Very High"))
CLEANLINESS = Scale((150, 300, 450, 600), ("Very Clean", "Clean", "Medium", "Dirty", "Very Dirty"))


def bucket(value: Column, scale: Scale = INTENSITY) -> Column:
    label = F.lit(scale.labels[-1])
    for bound, name in reversed(list(zip(scale.bounds, scale.labels))):
        label = F.when(value < bound, F.lit(name)).otherwise(label)
    return label
