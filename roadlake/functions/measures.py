"""Rounding, the speeding fine, and null handling of numeric measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

# The fine rule, and decimal places per measure.
SPEED_LIMIT = 150.0
FINE_AMOUNT = 1000
DECIMALS = {"speed": 2, "location_lat": 6, "location_lon": 6, "price_of_vechical": 2}


def round_measures(df: DataFrame, decimals: dict[str, int] = DECIMALS) -> DataFrame:
    """Round the measures that are present (half up, as ``round`` does in Spark)."""
    return df.withColumns({c: F.round(c, n) for c, n in decimals.items() if c in df.columns})


def speeding_fine(speed: Column | str, limit: float = SPEED_LIMIT, amount: int = FINE_AMOUNT) -> Column:
    """``amount`` when the speed, rounded to two places, is strictly above ``limit``; else 0.

    Spark sorts NaN above every number, so NaN is kept out of the comparison by hand.
    """
    value = F.col(speed) if isinstance(speed, str) else speed
    fined = ~F.isnan(value) & (F.round(value, DECIMALS["speed"]) > limit)
    return F.when(fined, F.lit(amount)).otherwise(F.lit(0)).cast("int")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Null in place of NaN in float and double columns; other types have no NaN."""
    floats = [f for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))]
    if not floats:
        return df
    return df.withColumns({f.name: F.nanvl(f.name, F.lit(None).cast(f.dataType)) for f in floats})
