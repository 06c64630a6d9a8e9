"""Score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def gaussian(distance: Column, sigma: float) -> Column:
    """exp(-(d / sigma)^2); 0 for a null distance or a sigma that is not positive."""
    if sigma <= 0:
        return F.lit(0.0)
    return F.coalesce(F.exp(-(distance / sigma) * (distance / sigma)), F.lit(0.0))


def noisy_or(*scores: Column) -> Column:
    missed = F.lit(1.0)
    for s in scores:
        missed = missed * (1 - clamp01(s))
    return clamp01(1 - missed)
