"""Rounding that does not depend on the order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUDGE = 1e-9


def settled(c: Column | str, digits: int) -> Column:
    """Rounded with halves going up.

    Means of rounded values often fall on a half, where the last bit of a sum
    would decide; the nudge is far above that bit and far below a digit.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(NUDGE), digits)
