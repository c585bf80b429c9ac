"""Weather codes to categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the kinds of weather (freezing drizzle counts as rain, freezing rain as snow).
SNOW = (66, 67, 71, 73, 75, 77, 85, 86)
RAIN = (51, 53, 55, 56, 57, 61, 63, 65, 80, 81, 82, 95, 96, 99)
FOG = (45, 48)
DRY = (0, 1, 2, 3)


def category(code: Column, precipitation: Column, snowfall: Column) -> Column:
    """Unknown, snow, rain, fog, dry, other: the first that holds. NaN counts as missing."""
    wet, snow = (F.when(~F.isnan(x.cast("double")), x) for x in (precipitation, snowfall))
    none = lambda x: F.coalesce(x == 0, F.lit(True))
    return (
        F.when(code.isNull() & wet.isNull() & snow.isNull(), "UNKNOWN_WEATHER")
        .when((snow > 0) | code.isin(*SNOW), "SNOWFALL_OR_FREEZING_PRECIPITATION")
        .when((wet > 0) | code.isin(*RAIN), "RAIN_OR_LIQUID_PRECIPITATION")
        .when(code.isin(*FOG), "FOG_OR_LOW_VISIBILITY")
        .when(code.isin(*DRY) & none(wet) & none(snow), "NO_RECORDED_PRECIPITATION")
        .otherwise("OTHER_OR_UNCLASSIFIED_WEATHER")
    )
