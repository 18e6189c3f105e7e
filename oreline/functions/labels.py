"""Value banding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreline.spec import GRADE_BANDS, OTHER_BAND


def grade_band(value: Column, bands=GRADE_BANDS, other: str = OTHER_BAND) -> Column:
    """Label of the band holding ``value``; NULL falls in the ``other`` band."""
    (label, low, high), *rest = bands
    banded = F.when(value.between(low, high), F.lit(label))
    for label, low, high in rest:
        banded = banded.when(value.between(low, high), F.lit(label))
    return banded.otherwise(F.lit(other))
