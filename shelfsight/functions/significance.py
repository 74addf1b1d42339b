"""Two-sided normal p-values as column expressions; Spark SQL has no error function."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the series and levels of the continued fraction: both then reach double precision on their side of 3.
TERMS = 80


def erfc(x: Column) -> Column:
    """The complementary error function of x >= 0.

    Up to 3 the series of positive terms x, x (2x²)/3, x (2x²)²/15, ... gives erf; beyond
    it the continued fraction x + (1/2)/(x + 1/(x + (3/2)/(x + ...))) gives erfc itself,
    so small values keep their leading digits.
    """
    bell = F.exp(-x * x) / math.sqrt(math.pi)
    down = F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1))
    series = F.aggregate(down, F.lit(1.0), lambda s, k: 1 + s * (2 * x * x) / (2 * k + 1))
    fraction = F.aggregate(down, x, lambda s, k: x + k / (2 * s))
    return F.when(x < 3, 1 - 2 * x * bell * series).when(x >= 3, bell / fraction)


def two_sided_p(z: str | Column) -> Column:
    """P(|N(0,1)| >= |z|); NULL stays NULL, and p is 0 where it is too small for a double."""
    value = F.abs(F.col(z) if isinstance(z, str) else z).cast("double")
    # Beyond 60 the value is below the smallest double.
    held = F.least(value, F.lit(60.0))
    return F.when(value.isNotNull() & ~F.isnan(value), erfc(held / math.sqrt(2.0)))
