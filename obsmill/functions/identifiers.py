"""Names of coded columns where they are rows (a long layout), and classes of metric columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsmill.plans.rules import ALIASES, FAMILIES, PREFIXES, REPEATS

#: Classes of columns by words in the name and by its beginning; the first that fits counts.
CLASSES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "temperature": (("temperature", "extreme_temp", "temp_c", "heat_index", "wind_chill"), tuple("TMP KA KB KC KD KE KF KG KH KI KJ KK KL KM KN KO KP KQ KR KS KT KU KV CW CT CU CV CX".split())),
    "dew_point": (("dew_point", "dew_"), ("DEW",)),
    "wind": (("wind_", "windspeed", "wind_speed", "wind_direction", "wind_type", "gust"), ("WND", "OA", "OB", "OC", "OD", "OE")),
    "pressure": (("pressure", "altimeter", "barometer"), ("SLP", "MA", "MD", "MF", "MG", "MH")),
    "visibility_ceiling": (("visibility", "ceiling", "cavok"), ("VIS", "CIG")),
    "precipitation": (("precip", "rain", "snow", "drizzle", "hail", "liquid"), tuple(f"A{x}" for x in "ABCDEFGHIJKLMNOPQRS")),
    "cloud_solar": (("cloud", "sky_cover", "solar", "sun", "irradiance", "radiation"), tuple("GA GD GE GF GG GH GJ GK GL GM GN GO GP GQ GR GS GT GU GV GW GX GY GZ".split())),
    "weather_occurrence": (("weather", "thunder", "lightning", "storm", "tornado", "funnel"), ("AY", "AZ", "AW", "MW")),
}
#: Columns of all classes.
COMMON = tuple("station_id STATION DATE YEAR SOURCE NAME REPORT_TYPE CALL_SIGN QUALITY_CONTROL Year MonthNum MonthName Day Hour row_has_any_usable_metric usable_metric_count usable_metric_fraction".split())


def known(identifier: Column) -> Column:
    """Whether a name is that of a coded column: listed, element-quality data, or a family with its own digit."""
    eqd = identifier.rlike(r"^[QPRCDN]\d")
    repeated = reduce(lambda c, x: c.when(identifier.startswith(x[0]), identifier.rlike(f"^..[1-{x[1]}]$")), list(REPEATS.items())[1:], F.when(identifier.startswith("AA"), identifier.rlike(f"^..[1-{REPEATS['AA']}]$")))
    others = [p for p in PREFIXES if p not in REPEATS]
    other = identifier.rlike(f"^({'|'.join(others)})[0-9]*$")
    return F.when(identifier.isin(*FAMILIES, *ALIASES), True).when(eqd, identifier.rlike(r"^[QPRCDN]\d\d$") & ~identifier.endswith("00")).otherwise(F.coalesce(repeated, other))


def class_of(column: str) -> str:
    """The class of a metric column; common columns are of none, others of no class are ``other``."""
    if column in COMMON:
        return "common"
    low, up = column.lower(), column.upper()
    return next((k for k, (words, begins) in CLASSES.items() if any(w in low for w in words) or up.startswith(begins)), "other")
