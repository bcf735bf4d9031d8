"""Unit conversions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of the columns converted (what follows stays at the end), names of the columns made and their factors.
CONVERSIONS = [
    (r"(?P<name>temperature_c|dew_point_c|extreme_temp_c_\d+)", {"{name}_f": lambda x: x * 9.0 / 5.0 + 32.0}),
    (r"(?P<name>wind_speed_ms|wind_gust_ms)", {"{name}_kt": lambda x: x * 1.9438444924, "{name}_mph": lambda x: x * 2.2369362921}),
    (r"(?P<name>visibility_m)", {"visibility_mi": lambda x: x / 1609.344}),
    (r"(?P<name>sea_level_pressure_hpa|altimeter_setting_hpa|station_pressure_hpa)", {"{name}_inhg": lambda x: x * 0.0295299830714}),
]


def add_units(df: DataFrame) -> DataFrame:
    """df with converted columns of temperatures, winds, visibility and pressures; others, and text columns, stay as they are."""
    added: dict[str, Column] = {}
    for name, kind in df.dtypes:
        for pattern, made in CONVERSIONS:
            m = re.match(pattern, name)
            if m and kind in ("double", "float", "int", "bigint"):
                added |= {to.format(name=m["name"]) + name[m.end() :]: f(F.col(name)) for to, f in made.items()}
                break
    return df.withColumns(added)
