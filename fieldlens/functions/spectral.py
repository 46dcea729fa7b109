"""Band arithmetic as Column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Score scales and clip limits of the change confidence.
NDBI_FULL_SCALE = 0.30
NDVI_FULL_SCALE = 0.50
CONFIDENCE_FLOOR = 0.05
CONFIDENCE_CEIL = 0.99


def normalized_difference(a: Column, b: Column, dtype: str = "double") -> Column:
    """(a - b) / (a + b), 0 where the denominator is 0. ``dtype='float'`` gives float32 results."""
    total = a + b
    return F.when(total != 0, (a - b) / total).otherwise(F.lit(0.0)).cast(dtype)


def ndvi(nir: Column, red: Column, dtype: str = "double") -> Column:
    return normalized_difference(nir, red, dtype)


def ndbi(swir: Column, nir: Column, dtype: str = "double") -> Column:
    return normalized_difference(swir, nir, dtype)


def change_predicate(ndbi_delta: Column, ndvi_drop: Column, ndbi_min: float, ndvi_min: float) -> Column:
    """Built-up rise and vegetation loss together; both limits inclusive."""
    return (ndbi_delta >= F.lit(ndbi_min)) & (ndvi_drop >= F.lit(ndvi_min))


def confidence(mean_delta: Column, mean_drop: Column) -> Column:
    rise = F.least(mean_delta / F.lit(NDBI_FULL_SCALE), F.lit(1.0))
    loss = F.least(mean_drop / F.lit(NDVI_FULL_SCALE), F.lit(1.0))
    return F.greatest(
        F.lit(CONFIDENCE_FLOOR), F.least(F.lit(CONFIDENCE_CEIL), F.lit(0.5) * rise + F.lit(0.5) * loss)
    )


def normalized_difference_array(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`normalized_difference` on arrays; NaN where either side is NaN."""
    total = a + b
    return np.divide(a - b, total, out=np.zeros(len(total)), where=total != 0)
