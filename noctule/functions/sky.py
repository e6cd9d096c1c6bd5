"""Light pollution ratio to darkness score and Bortle class."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from noctule import constants as K

NAN = float("nan")


def alr_to_darkness(alr: Column) -> Column:
    """Darkness in [0, 1], 1 darkest: a log scale between the dark and the bright ratio, clipped.

    NaN (no data) stays NaN; Spark's ``least``/``greatest`` would turn it into 1. A ratio below
    ``-ALR_EPS`` has no logarithm and gives NaN, where Spark's ``log10`` alone gives NULL.
    """
    lo, hi = math.log10(K.ALR_DARK), math.log10(K.ALR_BRIGHT)
    shifted = alr + F.lit(K.ALR_EPS)
    score = F.lit(1.0) - (F.log10(shifted) - F.lit(lo)) / F.lit(hi - lo)
    return (
        F.when(alr.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(alr) | (shifted < 0), F.lit(NAN))
        .when(shifted == 0, F.lit(1.0))
        .otherwise(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))
    )


def alr_to_bortle(alr: Column) -> Column:
    """Bortle class 1..9; NaN and NULL are class 9, a ratio above the last bound is class 8."""
    cls = F.when(alr.isNull() | F.isnan(alr), F.lit(K.BORTLE_NO_DATA))
    for bound, value in K.BORTLE_THRESHOLDS:
        cls = cls.when(alr <= F.lit(bound), F.lit(value))
    return cls.otherwise(F.lit(K.BORTLE_ABOVE)).cast("int")
