"""Rules of coded cells: for each family, its parts; for each part, how a token becomes a value."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import lru_cache

#: Quality codes of the public observation format.
QUALITY = tuple("012345679ACIMPRU")
MANDATORY_QUALITY = tuple("012345679")
MANDATORY_OR_MANUAL = tuple("012345679M")
PRECIPITATION_QUALITY = tuple("012345679AIMPRU")
CHECKED_QUALITY = tuple("01239")
CRN_QUALITY = tuple("139")
CRN_FLAG = tuple("0123456789")
DAILY_QUALITY = tuple("45679")
DAILY_OR_MANUAL = tuple("45679M")
SUSPECT_QUALITY = ("3", "7")


@dataclass(frozen=True)
class Span:
    """The numbers from low to high, each of ``width`` digits."""

    low: int
    high: int
    width: int


@dataclass(frozen=True)
class Part:
    """A part of a cell. ``sentinels`` None: two nines or more; empty: never missing. ``allowed``: codes of a quality part."""

    kind: str
    name: str = ""
    scale: float = 1.0
    low: float | None = None
    high: float | None = None
    sentinels: tuple[str, ...] | None = None
    quality: int | None = None
    allowed: tuple[str, ...] | None = None
    width: int | None = None
    values: tuple[str, ...] | Span | None = None
    pattern: str | None = None
    token: str | None = None
    rollup: str = "mean"
    cap: float | None = None
    text: bool = False


def number(name: str = "", missing: str | None = None, **more) -> Part:
    return Part("numeric", name, sentinels=None if missing is None else (missing,), **more)


def code(name: str = "", missing: str | None = None, **more) -> Part:
    return Part("categorical", name, sentinels=None if missing is None else (missing,), **({"rollup": "drop"} | more))


def quality(allowed: tuple[str, ...], **more) -> Part:
    return Part("quality", allowed=allowed, rollup="drop", **({"width": 1} | more))


#: Code tables of the public observation format.
TABLES: dict[str, tuple[str, ...]] = {
    "source_flag": tuple("123456789ABCDEFGHIJKLMNO"),
    "report_type": tuple("AERO AUST AUTO BOGUS BRAZ COOPD COOPS CRB CRN05 CRN15 FM-12 FM-13 FM-14 FM-15 FM-16 FM-18 GREEN MESOH MESOS MESOW MEXIC NSRDB PCP15 PCP60 S-S-A SA-AU SAO SAOSP SHEF SMARS SOD SOM SURF SY-AE SY-AU SY-MT SY-SA WBO WNO".split()),
    "qc_process": ("V01", "V02", "V03"),
    "sky_cover_opaque": tuple("00 01 02 03 04 05 06 07 08 09 10 12 13 15 16 18 19 99".split()),
    "vertical_datum": tuple("AGL ALAT AP CFB CRD ESLW GCLWD HAT HHW HTWW HW HWFC IND ISLW LAT LLW LNLW LRLW LSD LW LWD LWFC MHHW MHLW MHW MHWN MHWS MLHW MLLW MLLWS MLWN MLW MLWS MSL MTL NC NT ST SWA TLLW UD UK WGS84E WGS84G".split()),
    "daily_weather_source": ("AU", "AW", "MW"),
    "daily_weather_type": tuple("01 02 03 04 05 06 07 08 09 10 11 12 13 14 15 16 17 18 19 21 22".split()),
    "daily_weather_abbreviation": tuple("FG FG+ TS PL GR GL DU HZ BLSN FC WIND BLPY BR DZ FZDZ RA FZRA SN UP MIFG FZFG".split()),
    "automated_weather": tuple("00 01 02 03 04 05 07 10 11 12 18 20 21 22 23 24 25 26 27 28 29 30 31 32 33 34 35 40 41 42 43 44 45 46 47 48 50 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 67 68 70 71 72 73 74 75 76 77 78 80 81 82 83 84 85 86 87 89 90 91 92 93 94 95 96 99".split()),
    "vicinity_weather": tuple("00 01 02 03 04 05 06 07 08 09".split()),
    "ice_phenomena": tuple("00 01 02 03 04 10 11 12 20 21 22 23 24 25 26 27 28 29 30 31 32 33 34 35 36 37 40 41 42 43 44 45 46 47 50 51 52 53 54 55 56 57 58 59 60 61 62 63 64 65 70 71 72 73".split()),
    "eqd_unit": tuple("ABCDEFGHIJKLMOPQR"),
    "eqd_element": tuple("ALC ALM ALTP CC51 CLC CLM CLHT CLT C2C3 DPTC DPTP HZVS PRES PWTH PWVC RHUM SCH SLVP TMCD TMPD TMPW TSCE TSKC TSKY WD16 WIND WND2".split()),
    "eqd_legacy": tuple("APC3 ATOLD WOSPD WOLSPD WOLDIR WODIR ATOLDS ATOLT ATOD ATOT APOSP APOSLP APOLP APOLH APOA WGOSPD APCQ24 APCTEN PRSWOA PSTWOP SCOCIG SCOHCG SCOLCB SCOLCG SCOMCG SCOTCV SCOTLC VODIS VOVAR PRCP ATMM ATMN ATMX SNDP SNWF PRSWM1 PRSWM2 PRSWM3 PRSWM4 PRSWM5 PRSWM6 PRSWM7 PRSWA1 PRSWA2 PRSWA3 PRSWA4 PSTWA1 PSTWA2 PSTWM1 PSTWM2".split()),
}
EQD_FLAGS = (tuple("ACDEGHIKMNPRSUWb "), tuple("0123456EMS"))
EQD_MONTHLY = "(?:A|D|T)(?:0[1-9]|1[0-2])(?:00[1-9]|0[1-7][0-9])"
DAY_TIME = "(0[1-9]|[12][0-9]|3[01])([01][0-9]|2[0-3])[0-5][0-9]"
TIME = "([01][0-9]|2[0-3])[0-5][0-9]"
DAYS_2 = "(0[1-9]|[12][0-9]|3[01]){2}"
DAYS_3 = "(?:0[1-9]|[12][0-9]|3[01]|99){3}"
SIGNED_4, DIGITS_4, DIGITS_5, DIGITS_3 = r"[+-]?\d{4}", r"\d{4}", r"\d{5}", r"\d{3}"
COVER_10, COVER_19 = Span(0, 10, 2), Span(0, 19, 2)


def crn(**more) -> tuple[Part, Part, Part]:
    """A value with its check code and its flag; the check code is the next part unless said."""
    return (number(**more), quality(CRN_QUALITY), quality(CRN_FLAG))


def day_counts(allowed: tuple[str, ...]) -> tuple[Part, ...]:
    return tuple(x for k in range(4) for x in (number(missing="99", quality=2 * k + 2, low=0, high=31, width=2), quality(allowed)))


#: Families of the public observation format; numeric bounds are before scaling.
FAMILIES: dict[str, tuple[Part, ...]] = {
    "WND": (
        number("wind_direction_deg", "999", quality=2, low=1, high=360, width=3, rollup="circular_mean"), quality(MANDATORY_QUALITY), code("wind_type_code", "9", values=tuple("ABCHNRQTV"), width=1),
        number("wind_speed_ms", "9999", scale=0.1, quality=5, low=0, high=900, width=4), quality(MANDATORY_QUALITY)),
    "CIG": (number("ceiling_height_m", "99999", quality=2, width=5, cap=22000), quality(MANDATORY_QUALITY), code("ceiling_determination", "9", values=tuple("ABCDEMPRSUVW"), width=1), code("cavok", "9", values=("N", "Y"), width=1)),
    "VIS": (number("visibility_m", "999999", quality=2, width=6, rollup="min", cap=160000), quality(MANDATORY_QUALITY), code("visibility_variability", "9", quality=4, values=("N", "V"), width=1), quality(MANDATORY_QUALITY)),
    "TMP": (number("temperature_c", "9999", scale=0.1, quality=2, allowed=QUALITY, low=-932, high=618, width=4),),
    "DEW": (number("dew_point_c", "9999", scale=0.1, quality=2, allowed=QUALITY, low=-982, high=368, width=4),),
    "SLP": (number("sea_level_pressure_hpa", "99999", scale=0.1, quality=2, allowed=MANDATORY_QUALITY, low=8600, high=10900, width=5),),
    "OC1": (number("wind_gust_ms", "9999", scale=0.1, quality=2, allowed=MANDATORY_OR_MANUAL, low=50, high=1100, width=4, rollup="max"),),
    "MA1": (number("altimeter_setting_hpa", "99999", scale=0.1, quality=2, low=8635, high=10904, width=5), quality(MANDATORY_OR_MANUAL), number("station_pressure_hpa", "99999", scale=0.1, quality=4, low=4500, high=10900, width=5), quality(MANDATORY_OR_MANUAL)),
    "MD1": (
        code("pressure_tendency_code", "9", quality=2, values=tuple("012345678"), width=1), quality(CHECKED_QUALITY), number("pressure_change_3hr_hpa", "999", scale=0.1, quality=4, low=0, high=500, width=3, token=DIGITS_3), quality(CHECKED_QUALITY),
        number("pressure_change_24hr_hpa", "999", scale=0.1, quality=6, low=-800, high=800, width=4, token=SIGNED_4), quality(CHECKED_QUALITY)),
    "SA1": (number("sea_surface_temperature_c", "999", scale=0.1, quality=2, allowed=CHECKED_QUALITY, low=-50, high=450, width=4, token=SIGNED_4),),
    "UA1": (
        code("wave_method", "9", quality=4, values=("M", "I"), width=1), number("wave_period_seconds", "99", quality=4, values=Span(0, 30, 2), low=0, high=30, width=2), number("wave_height_m", "999", scale=0.1, quality=4, values=Span(0, 500, 3), low=0, high=500, width=3),
        quality(CHECKED_QUALITY), code("sea_state", "99", quality=6, values=Span(0, 9, 2), width=2), quality(CHECKED_QUALITY)),
    "WA1": (code("", "9", quality=4, values=tuple("12345"), width=1), number("", "999", scale=0.1, quality=4, values=Span(0, 998, 3), width=3), code("", "9", quality=4, values=tuple("01234"), width=1), quality(CHECKED_QUALITY)),
    "WD1": (
        code("", "99", quality=11, values=Span(0, 10, 2), width=2), number("", "999", quality=11, values=Span(0, 100, 3), width=3), code("", "99", quality=11, values=("06", "07", "08", "09"), width=2), code("", "9", quality=11, values=tuple("012"), width=1),
        code("", "9", quality=11, values=tuple("123"), width=1), code("", "9", quality=11, values=tuple("123456"), width=1), code("", "99", quality=11, values=Span(0, 9, 2), width=2), code("", "9", quality=11, values=tuple("012"), width=1),
        number("", "999", quality=11, values=Span(0, 998, 3), width=3), number("", "999", quality=11, values=Span(0, 998, 3), width=3), quality(CHECKED_QUALITY)),
    "WG1": (
        code("", "99", quality=6, values=Span(0, 10, 2), width=2), number("", "99", quality=6, values=Span(0, 98, 2), width=2, rollup="drop"), code("", "99", quality=6, values=Span(0, 9, 2), width=2),
        code("", "99", quality=6, values=Span(0, 9, 2), width=2), code("", "99", quality=6, values=Span(0, 9, 2), width=2), quality(CHECKED_QUALITY)),
    "WJ1": (
        number("", "999", values=Span(0, 998, 3), width=3), number("", "99999", values=Span(0, 99998, 5), width=5), code("", "99", values=TABLES["ice_phenomena"], width=2), code("", "99", values=TABLES["ice_phenomena"], width=2),
        number("", "9999", pattern=r"\+?\d{4}|-0\d{3}", width=4), code("", "9", values=tuple("0123"), width=1), code("", "9", values=tuple("BHNO"), width=1)),
    "UG1": (number("swell_period_seconds", "99", quality=4, values=Span(0, 14, 2), width=2), number("swell_height_m", "999", scale=0.1, quality=4, values=Span(0, 500, 3), width=3), number("swell_direction_deg", "999", quality=4, values=Span(1, 360, 3), width=3, rollup="circular_mean"), quality(CHECKED_QUALITY)),
    "UG2": (number("", "99", quality=4, values=Span(0, 14, 2), width=2), number("", "999", scale=0.1, quality=4, values=Span(0, 500, 3), width=3), number("", "999", quality=4, values=Span(1, 360, 3), width=3, rollup="circular_mean"), quality(CHECKED_QUALITY)),
    "GE1": (code("convective_cloud", "9", values=tuple("012345679"), width=1), code("vertical_datum", "999999", values=TABLES["vertical_datum"]), number("cloud_base_height_upper_m", "99999", low=-400, high=15000, width=5), number("cloud_base_height_lower_m", "99999", low=-400, high=15000, width=5)),
    "GF1": (
        number("cloud_total_coverage", "99", quality=3, values=COVER_19, width=2), number("cloud_opaque_coverage", "99", values=TABLES["sky_cover_opaque"], width=2), quality(MANDATORY_OR_MANUAL), number("", "99", quality=5, values=COVER_19, width=2), quality(MANDATORY_OR_MANUAL),
        code("", "99", values=Span(0, 9, 2), width=2), quality(MANDATORY_OR_MANUAL), number("", "99999", quality=9, low=-400, high=15000, width=5), quality(MANDATORY_OR_MANUAL), code("", "99", values=Span(0, 9, 2), width=2), quality(MANDATORY_OR_MANUAL),
        code("", "99", values=Span(0, 9, 2), width=2), quality(MANDATORY_OR_MANUAL)),
    "CO1": (code("", "99", values=Span(0, 9, 2), low=0, high=9, width=2), code("", "99", pattern=r"[+-]?(0\d|1[0-2])", width=3, token=r"[+-]\d{2}")),
    "KE1": day_counts(MANDATORY_QUALITY),
    "KF1": (number("derived_air_temp_c", "9999", scale=0.1, quality=2, low=-9999, high=9998, width=4, token=SIGNED_4), quality(CRN_QUALITY)),
    "ST1": (
        code("", "9", values=tuple("1234"), low=1, high=9, width=1), number("", "9999", scale=0.1, quality=3, low=-1100, high=630, width=4, token=SIGNED_4), quality(DAILY_QUALITY), number("", "9999", scale=0.1, quality=5, low=0, high=9998, pattern=DIGITS_4, width=4, token=DIGITS_4), quality(DAILY_QUALITY),
        code("", "99", values=Span(1, 8, 2), low=1, high=99, width=2), quality(DAILY_QUALITY), code("", "9", values=tuple("012345678"), low=0, high=9, width=1), quality(DAILY_QUALITY)),
    "ME1": (code("geopotential_level", "9", values=tuple("12345"), width=1), number("geopotential_height_m", "9999", quality=3, low=0, high=9998, width=4, token=DIGITS_4), quality(CHECKED_QUALITY)),
    "MF1": (number("station_pressure_day_avg_hpa", "99999", scale=0.1, quality=2, low=4500, high=10900, width=5, token=DIGITS_5), quality(MANDATORY_QUALITY), number("sea_level_pressure_day_avg_hpa", "99999", scale=0.1, quality=4, low=8600, high=10900, width=5, token=DIGITS_5), quality(MANDATORY_QUALITY)),
    "MG1": (number("", "99999", scale=0.1, quality=2, low=4500, high=10900, width=5, token=DIGITS_5), quality(DAILY_OR_MANUAL), number("", "99999", scale=0.1, quality=4, low=8600, high=10900, width=5, token=DIGITS_5), quality(DAILY_OR_MANUAL)),
    "MH1": (number("", "99999", scale=0.1, quality=2, low=4500, high=10900, width=5, token=DIGITS_5), quality(MANDATORY_OR_MANUAL), number("", "99999", scale=0.1, quality=4, low=8600, high=10900, width=5, token=DIGITS_5), quality(MANDATORY_OR_MANUAL)),
    "MK1": (
        number("", "99999", scale=0.1, quality=3, low=8600, high=10900, width=5, token=DIGITS_5), code("", "999999", pattern=DAY_TIME, width=6, token=DAY_TIME), quality(MANDATORY_OR_MANUAL),
        number("", "99999", scale=0.1, quality=6, low=8600, high=10900, width=5, token=DIGITS_5), code("", "999999", pattern=DAY_TIME, width=6, token=DAY_TIME), quality(MANDATORY_OR_MANUAL)),
    "GP1": (code("", "9999", values=Span(1, 9998, 4), width=4), *(x for _ in range(3) for x in (number("", "9999", low=0, high=9998, width=4), code("", "99", values=("01", "02", "03"), width=2), number("", "999", low=0, high=100, width=3)))),
    "GQ1": (code("", "9999", values=Span(1, 9998, 4), width=4), *(x for k in (3, 5) for x in (number("", "9999", scale=0.1, quality=k, low=0, high=3600, width=4), quality(CHECKED_QUALITY, sentinels=("9",))))),
    "GR1": (code("", "9999", values=Span(1, 9998, 4), width=4), *(x for k in (3, 5) for x in (number("", "9999", quality=k, low=0, high=9998, width=4), quality(CHECKED_QUALITY)))),
    "HAIL": (number("hail_size_cm", "999", scale=0.1, quality=2, allowed=CHECKED_QUALITY, low=0, high=200, width=3),),
    "IA1": (code("ground_condition", "99", quality=2, values=Span(0, 31, 2), width=2), quality(CHECKED_QUALITY)),
    "IA2": (number("", "999", scale=0.1, quality=3, low=1, high=480, width=3, pattern=DIGITS_3), number("ground_minimum_temperature_c", "9999", scale=0.1, quality=3, low=-1100, high=1500, width=4, pattern=SIGNED_4), quality(CHECKED_QUALITY, values=CHECKED_QUALITY)),
    "IB1": tuple(x for k, low in ((2, -9999), (5, -9999), (8, -9999), (11, 0)) for x in (number("", "9999", scale=0.1, quality=k, low=low, high=9998, width=4), quality(CRN_QUALITY, values=CRN_QUALITY), quality(CRN_FLAG, sentinels=("9",)))),
    "IB2": (*crn(missing="9999", scale=0.1, quality=2, low=-9999, high=9998, width=4), *crn(missing="9999", scale=0.1, quality=5, low=0, high=9998, width=4)),
    "IC1": (
        number("", "99", low=1, high=98, width=2), number("", "9999", quality=4, low=0, high=9998, width=4), code("", "9", values=tuple("123"), quality=4, width=1), quality(DAILY_QUALITY), number("", "999", scale=0.01, quality=7, low=0, high=998, width=3), code("", "9", values=tuple("123"), quality=7, width=1), quality(DAILY_QUALITY),
        number("", "999", scale=0.1, quality=10, low=-100, high=500, width=3, token=r"[+-]?\d{3}"), code("", "9", values=tuple("123"), quality=10, width=1), quality(DAILY_QUALITY), number("", "999", scale=0.1, quality=13, low=-100, high=500, width=3, token=r"[+-]?\d{3}"), code("", "9", values=tuple("123"), quality=13, width=1), quality(DAILY_QUALITY)),
    "ED1": (number("runway_direction_deg", "99", scale=10.0, quality=4, values=Span(1, 36, 2), width=2), code("runway_designator", "9", values=tuple("LCRU"), quality=4, width=1), number("runway_visibility_m", "9999", quality=4, values=Span(0, 5000, 4), width=4), quality(CHECKED_QUALITY)),
    "CR1": (number("", "99999", scale=0.001, quality=2, low=0, high=99998, width=5), quality(CRN_QUALITY, width=None), quality(CRN_FLAG, width=None)),
    "CI1": tuple(replace(x, width=x.width if x.kind == "numeric" else None) for x in (
        *crn(missing="9999", scale=0.1, quality=2, low=-9999, high=9999, width=5), *crn(missing="9999", scale=0.1, quality=5, low=-9999, high=9998), *crn(missing="99999", scale=0.1, quality=8, low=0, high=99998), *crn(missing="99999", scale=0.1, quality=11, low=0, high=99998, width=5, pattern=DIGITS_5))),
    "CN1": tuple(x for k in (2, 5, 8) for x in crn(missing="9999", scale=0.1, quality=k, low=0, high=9998, width=4)),
    "CN2": (*crn(missing="9999", scale=0.1, quality=2, low=-9999, high=9998, width=4), *crn(missing="9999", scale=0.1, quality=5, low=-9999, high=9998, width=4), *crn(missing="99", quality=8, low=0, high=60, width=2)),
    "CN3": tuple(x for k in (2, 5) for x in crn(missing="999999", scale=0.1, quality=k, low=0, high=999998, width=6)),
    "CN4": (
        code("", "9", values=("0", "1", "9"), quality=2, width=1), quality(CRN_QUALITY), quality(CRN_FLAG), *crn(missing="9999", quality=5, low=0, high=8192, width=4), *crn(missing="999", scale=0.1, quality=8, low=0, high=500, width=3),
        *crn(missing="999", scale=0.1, quality=11, low=0, high=500, width=3)),
}
#: Families by the beginning of the name.
PREFIXES: dict[str, tuple[Part, ...]] = {
    "AA": (number("precip_period_hours", "99", low=0, high=98, width=2, rollup="drop"), number("precip_amount", "9999", scale=0.1, quality=4, low=0, high=9998, width=4, rollup="sum"), code("precip_condition", "9", values=tuple("123456789EIJ"), width=1), quality(PRECIPITATION_QUALITY)),
    "AB": (number("precip_month_mm", "99999", scale=0.1, quality=3, low=0, high=50000, width=5), code("", "9", width=1), quality(PRECIPITATION_QUALITY)),
    "AC": (code("", "9", values=tuple("0123"), quality=3, width=1), code("", "9", values=("C", "I"), quality=3, width=1), quality(PRECIPITATION_QUALITY)),
    "AD": (number("", "99999", scale=0.1, quality=6, low=0, high=20000, width=5), code("", "9", width=1), *(code("", "9999", pattern=DAYS_2, low=101, high=3131, width=4) for _ in range(3)), quality(PRECIPITATION_QUALITY)),
    "AE": day_counts(PRECIPITATION_QUALITY),
    "AG": (code("", "9", values=tuple("012345"), width=1), number("", "999", low=0, high=998, width=3)),
    "AH": (number("", "999", low=5, high=45, width=3, rollup="drop"), number("", "9999", scale=0.1, quality=5, low=0, high=3000, width=4), code("", "9", values=("1", "2"), width=1), code("", "999999", pattern=DAY_TIME, width=6), quality(PRECIPITATION_QUALITY)),
    "AI": (number("", "999", low=60, high=180, width=3, rollup="drop"), number("", "9999", scale=0.1, quality=5, low=0, high=3000, width=4), code("", "9", values=("1", "2"), width=1), code("", "999999", pattern=DAY_TIME, width=6), quality(PRECIPITATION_QUALITY)),
    "AJ": (
        number("snow_depth", "9999", quality=3, low=0, high=1200, width=4), code("snow_depth_condition", "9", width=1), quality(PRECIPITATION_QUALITY),
        number("snow_water_equivalent", "999999", scale=0.1, quality=6, low=0, high=120000, width=6), code("snow_water_condition", "9", width=1), quality(PRECIPITATION_QUALITY)),
    "AK": (number("", "9999", quality=4, low=0, high=1500, width=4), code("", "9", values=tuple("1234"), width=1), code("", "999999", pattern=DAYS_3, width=6), quality(PRECIPITATION_QUALITY)),
    "AL": (number("snow_accum_period_hours", "99", low=0, high=72, width=2, rollup="drop"), number("snow_accum_depth_cm", "999", quality=4, low=0, high=500, width=3, rollup="sum"), code("snow_accum_condition", "9", values=tuple("123456E"), width=1), quality(MANDATORY_OR_MANUAL)),
    "AM": (number("", "9999", scale=0.1, quality=6, low=0, high=2000, width=4), code("", "9", values=tuple("1234"), width=1), *(code("", "9999", pattern=DAYS_2, width=4) for _ in range(3)), quality(MANDATORY_QUALITY)),
    "AN": (number("", "999", low=1, high=744, width=3, rollup="drop"), number("", "9999", scale=0.1, quality=4, low=0, high=9998, width=4), code("", "9", values=tuple("1234567E"), width=1), quality(MANDATORY_OR_MANUAL)),
    "AO": (number("precip_minute_period_minutes", "99", low=0, high=98, width=2, rollup="drop"), number("precip_minute_amount_mm", "9999", scale=0.1, quality=4, low=0, high=9998, width=4, rollup="sum"), code("precip_minute_condition", "9", values=tuple("12345678EIJ"), width=1), quality(MANDATORY_QUALITY)),
    "AP": (number("", "9999", scale=0.1, quality=3, low=0, high=9998, width=4), code("", "9", values=("9",), width=1), quality(MANDATORY_QUALITY)),
    "AT": (code("", quality=4, values=TABLES["daily_weather_source"], width=2), code("", quality=4, values=TABLES["daily_weather_type"], width=2, text=True), code("", quality=4, values=TABLES["daily_weather_abbreviation"], width=4), quality(MANDATORY_OR_MANUAL)),
    "AU": (
        code("", "9", quality=7, values=tuple("01234"), width=1), code("", "9", quality=7, values=tuple("012345678"), width=1), code("", "99", quality=7, values=Span(0, 9, 2), width=2), code("", "9", quality=7, values=tuple("012345678"), width=1),
        code("", "9", quality=7, values=tuple("012345"), width=1), code("", "9", quality=7, values=tuple("123"), width=1), quality(MANDATORY_OR_MANUAL)),
    "AW": (Part("categorical", "present_weather_automated", sentinels=(), quality=2, values=TABLES["automated_weather"], width=2, rollup="drop", text=True), quality(MANDATORY_OR_MANUAL)),
    "AX": (code("", "99", quality=2, values=Span(0, 11, 2), width=2), quality(DAILY_QUALITY), code("", "99", quality=4, values=("24",), width=2), quality(DAILY_QUALITY)),
    "AY": (code("past_weather_manual", quality=2, values=CRN_FLAG, width=1), quality(CHECKED_QUALITY), code("", "99", quality=4, values=Span(1, 24, 2), width=2), quality(CHECKED_QUALITY)),
    "AZ": (code("past_weather_automated", quality=2, values=CRN_FLAG, width=1), quality(CHECKED_QUALITY), code("", "99", quality=4, values=Span(1, 24, 2), width=2), quality(CHECKED_QUALITY)),
    "CB": (code("", "99", values=Span(5, 60, 2), width=2), *crn(missing="99999", scale=0.1, quality=3, low=-99999, high=99998, width=5)),
    "CF": crn(missing="9999", scale=0.1, quality=2, low=0, high=9998, width=4),
    "CG": crn(missing="99999", scale=0.1, quality=2, low=-99999, high=99998, width=5),
    "CH": (code("", "99", values=Span(0, 60, 2), width=2), *crn(missing="9999", scale=0.1, quality=3, low=-9999, high=9998, width=5), *crn(missing="9999", scale=0.1, quality=6, low=0, high=1000, width=4)),
    "CI": tuple(replace(x, width=x.width if x.kind == "numeric" else None, values=CRN_QUALITY if x.allowed == CRN_QUALITY else None) for x in (
        *crn(missing="9999", scale=0.1, quality=2, low=-9999, high=9998), *crn(missing="9999", scale=0.1, quality=5, low=-9999, high=9998), *crn(missing="9999", scale=0.1, quality=8, low=0, high=9998), *crn(missing="99999", scale=0.1, quality=11, low=0, high=1000, width=5, pattern=DIGITS_5))),
    "CO": (code("", "999", pattern=r"[\x20-\x7E]{3}", width=3), number("", "9999", scale=0.1, pattern=SIGNED_4, width=4, token=r"[+-]\d{4}")),
    "CT": (number("subhourly_temp_avg_c", "9999", scale=0.1, quality=2, low=-9999, high=9998, width=4, token=r"[+-]\d{4}"), quality(CRN_QUALITY, width=None), quality(CRN_FLAG, width=None)),
    "CU": (*crn(missing="9999", scale=0.1, quality=2, low=-9999, high=9998, width=4, token=r"[+-]\d{4}"), *crn(missing="9999", scale=0.1, quality=5, low=0, high=9998, width=4, token=DIGITS_4)),
    "CV": tuple(x for k, high in ((2, 9998), (8, 9999)) for x in (*crn(missing="9999", scale=0.1, quality=k, low=-9999, high=high, width=4, token=r"[+-]\d{4}"), code("", "9999", quality=k + 3, pattern=TIME, width=4, token=TIME), quality(CRN_QUALITY), quality(CRN_FLAG))),
    "CW": tuple(x for k in (2, 5) for x in crn(missing="99999", scale=0.1, quality=k, low=0, high=99999, width=5, token=DIGITS_5)),
    "CX": (
        *crn(missing="99999", scale=0.1, quality=2, low=-99999, high=99999, width=5, token=r"[+-]\d{5}"), *crn(missing="9999", quality=5, low=0, high=9999, width=4, token=DIGITS_4),
        *crn(missing="9999", quality=8, low=0, high=9998, width=4, token=DIGITS_4), *crn(missing="9999", quality=11, low=0, high=9998, width=4, token=DIGITS_4)),
    "GA": (number("cloud_layer_coverage", "99", quality=2, values=COVER_10, low=0, high=100, width=2), quality(MANDATORY_OR_MANUAL), number("cloud_layer_base_height_m", "99999", quality=4, low=-400, high=35000, width=5), quality(MANDATORY_OR_MANUAL), code("cloud_layer_type", "99", quality=6, values=Span(0, 23, 2), width=2), quality(MANDATORY_OR_MANUAL)),
    "GD": (code("", "9", quality=3, values=tuple("0123456"), width=1), code("", "99", quality=3, values=COVER_19, width=2), quality(MANDATORY_QUALITY), number("", "99999", quality=5, low=-400, high=35000, width=5), quality(MANDATORY_QUALITY), code("", "9", values=tuple("1234"), width=1)),
    "GG": (
        number("", "99", quality=2, values=COVER_10, low=0, high=100, width=2), quality(CHECKED_QUALITY), number("", "99999", quality=4, low=0, high=35000, width=5), quality(CHECKED_QUALITY), code("", "99", quality=6, values=Span(0, 10, 2), width=2), quality(CHECKED_QUALITY),
        code("", "99", quality=8, values=Span(0, 9, 2), width=2), quality(CHECKED_QUALITY)),
    "GH": tuple(x for k in (2, 5, 8, 11) for x in (number("", "99999", scale=0.1, quality=k, low=0, high=99998, width=5, **({"pattern": DIGITS_5} if k == 11 else {"token": DIGITS_5})), quality(CRN_QUALITY), code("", values=CRN_FLAG, width=1))),
    "GJ": (number("sunshine_minutes", "9999", quality=2, low=0, high=6000, width=4), quality(MANDATORY_OR_MANUAL)),
    "GK": (number("sunshine_percent", "999", quality=2, low=0, high=100, width=3), quality(DAILY_OR_MANUAL)),
    "GL": (number("sunshine_month_minutes", "99999", quality=2, low=0, high=30000, width=5), quality(MANDATORY_QUALITY)),
    "GM": (code("", "9999", values=Span(1, 9998, 4), width=4), *(x for k in (4, 7, 10) for x in (number("", "9999", quality=k, low=0, high=9998, width=4), code("", "99", values=Span(0, 99, 2), width=2), quality(CHECKED_QUALITY))), number("", "9999", quality=12, low=0, high=9998, width=4), quality(CHECKED_QUALITY)),
    "GN": (code("", "9999", values=Span(1, 9998, 4), width=4), *(x for k in (3, 5, 7, 9) for x in (number("", "9999", quality=k, low=0, high=9998, width=4), quality(CHECKED_QUALITY))), number("", "999", quality=11, low=0, high=998, width=3), quality(CHECKED_QUALITY)),
    "GO": (code("", "9999", values=Span(1, 9998, 4), width=4), *(x for k in (3, 5, 7) for x in (number("", "9999", quality=k, low=-999, high=9998, width=4), quality(CHECKED_QUALITY)))),
    "KA": (number("extreme_temp_period_hours", "999", scale=0.1, low=1, high=480, width=3), code("extreme_temp_code", "9", values=tuple("NMOP"), width=1), number("extreme_temp_c", "9999", scale=0.1, quality=4, low=-932, high=618, width=4, token=SIGNED_4), quality(MANDATORY_OR_MANUAL)),
    "KB": (number("avg_air_temp_period_hours", "999", low=1, high=744, width=3, rollup="drop"), code("avg_air_temp_code", "9", values=tuple("AMN"), width=1), number("avg_air_temp_c", "9999", scale=0.01, quality=4, low=-9900, high=6300, width=4, token=SIGNED_4), quality(MANDATORY_QUALITY)),
    "KC": (code("", "9", values=("N", "M"), width=1), code("", "9", values=("1",), width=1), number("", "9999", scale=0.1, quality=5, low=-1100, high=630, width=4, token=SIGNED_4), code("", "999999", pattern=DAYS_3, width=6, token=DAYS_3), quality(MANDATORY_OR_MANUAL)),
    "KD": (number("", "999", low=1, high=744, width=3, rollup="drop"), code("", "9", values=("H", "C"), width=1), number("", "9999", quality=4, low=0, high=5000, width=4, token=DIGITS_4), quality(MANDATORY_QUALITY)),
    "KG": (number("", "999", low=1, high=744, width=3, rollup="drop"), code("", "9", values=("D", "W"), width=1), number("", "9999", scale=0.1, quality=5, low=-9900, high=6300, width=4, token=SIGNED_4), code("", "9", values=("D",), width=1), quality(MANDATORY_QUALITY)),
    "MV": (code("vicinity_weather", "99", quality=2, values=TABLES["vicinity_weather"], width=2, text=True), quality(DAILY_QUALITY)),
    "MW": (code("present_weather_manual", quality=2, values=Span(0, 99, 2), width=2, text=True), quality(MANDATORY_OR_MANUAL)),
    "OA": (code("supp_wind_oa_type", "9", values=tuple("123456"), width=1), number("supp_wind_oa_period_hours", "99", values=Span(1, 48, 2), low=1, high=48, width=2, rollup="drop"), number("supp_wind_oa_speed_ms", "9999", scale=0.1, quality=4, values=Span(0, 2000, 4), low=0, high=2000, width=4, token=DIGITS_4), quality(CHECKED_QUALITY)),
    "OB": (
        number("", "999", values=Span(1, 998, 3), width=3, token=DIGITS_3, rollup="drop"), number("", "9999", scale=0.1, quality=3, values=Span(0, 9998, 4), width=4, token=DIGITS_4), quality(CRN_QUALITY), quality(CRN_FLAG), number("", "999", quality=6, values=Span(1, 360, 3), width=3, token=DIGITS_3, rollup="circular_mean"), quality(CRN_QUALITY), quality(CRN_FLAG),
        number("", "99999", scale=0.01, quality=9, values=Span(0, 99998, 5), width=5, token=DIGITS_5), quality(CRN_QUALITY), quality(CRN_FLAG), number("", "99999", scale=0.01, quality=12, values=Span(0, 99998, 5), width=5, token=DIGITS_5), quality(CRN_QUALITY), quality(CRN_FLAG)),
    "OD": (
        code("supp_wind_type", "9", values=tuple("123456"), width=1), number("supp_wind_period_hours", "99", values=Span(1, 48, 2), low=1, high=48, width=2, rollup="drop"), number("supp_wind_direction_deg", "999", values=Span(1, 360, 3), low=1, high=360, width=3, rollup="circular_mean"),
        number("supp_wind_speed_ms", "9999", scale=0.1, quality=5, values=Span(0, 2000, 4), low=0, high=2000, width=4), quality(CHECKED_QUALITY, sentinels=("9",))),
    "OE": (
        code("", values=tuple("12345"), width=1), number("", "99", values=("24",), low=24, high=24, width=2, rollup="drop"), number("", "99999", scale=0.01, quality=6, values=Span(0, 20000, 5), low=0, high=20000, width=5), number("", "999", quality=6, values=Span(1, 360, 3), low=1, high=360, width=3, rollup="circular_mean"),
        number("", "9999", quality=6, values=Span(0, 2359, 4), pattern=TIME, low=0, high=2359, width=4, rollup="drop"), quality(DAILY_OR_MANUAL)),
    "RH": (number("relative_humidity_period_hours", "999", low=1, high=744, width=3, rollup="drop"), code("relative_humidity_code", "9", values=tuple("MNX"), width=1), number("relative_humidity_percent", "999", quality=5, low=0, high=100, width=3), code("relative_humidity_derived", "9", values=("D",), width=1), quality(MANDATORY_QUALITY)),
}
#: Element-quality data: a letter and two digits.
EQD_REASON = (Part("categorical", "original_value", sentinels=(), rollup="drop", text=True), code("reason_code", values=tuple("01234567"), width=1), Part("categorical", "parameter", sentinels=(), rollup="drop"))
EQD_UNIT = (Part("categorical", "original_value", sentinels=(), rollup="drop", text=True), code("unit_code", values=TABLES["eqd_unit"], width=1), Part("categorical", "parameter", sentinels=(), rollup="drop"))
#: How often a family may be repeated; its name is followed by one digit from 1 on.
REPEATS = {
    "AA": 4, "AH": 6, "AI": 6, "AL": 4, "AO": 4, "AT": 8, "AU": 9, "AW": 4, "AX": 6, "AY": 2, "AZ": 2, "CO": 9, "CT": 3, "CU": 3, "CV": 3, "CW": 1, "CX": 3, "GA": 6, "GD": 6, "GG": 6, "KA": 4, "KB": 3, "KC": 2, "KD": 2, "KG": 2,
    "MV": 7, "MW": 7, "OA": 3, "OD": 3, "OB": 2, "OE": 3, "RH": 3,
}
ALIASES = {"N2": "N02", "WND2": "WND"}
#: Numeric parts of these families have exactly as many digits as their sentinel.
ADDITIONAL = ("AA", "AB", "AC", "AD", "AE", "AG", "AH", "AI", "AJ", "AK", "AL", "AM", "AN", "AO", "AP")
FLAG_ONLY = ("AC", "AD", "AG", "AH")
CRN_FAMILIES = ("CB", "CF", "CG", "CH", "CI", "CN")
#: Families whose names are section tokens: three upper-case characters.
SECTIONS = "AA AT CB CO CR CT CU CV CW CX ED GA GJ GM GO GP GQ GR IA KA MA MV OA SA ST UA".split()


def is_eqd(identifier: str) -> bool | None:
    """Whether the name is a letter of element-quality data and two digits, not 00; None for other names."""
    if not re.match(r"[QPRCDN]\d", identifier):
        return None
    return bool(re.fullmatch(r"[QPRCDN]\d\d", identifier)) and identifier[1:] != "00"


def is_repeat(identifier: str) -> bool | None:
    """Whether a repeated family's name ends in one digit of its range; None for other families."""
    most = REPEATS.get(identifier[:2])
    return None if most is None else bool(re.fullmatch(r"\d", identifier[2:])) and 1 <= int(identifier[2:]) <= most


@lru_cache
def resolve(identifier: str) -> tuple[Part, ...] | None:
    """The parts of a column's cells; None for names that aren't coded columns."""
    identifier = ALIASES.get(identifier, identifier)
    if identifier in FAMILIES:
        return FAMILIES[identifier]
    eqd = is_eqd(identifier)
    if eqd is not None:
        return (EQD_UNIT if identifier[0] == "N" else EQD_REASON) if eqd else None
    if is_repeat(identifier) is False or identifier[:2] in SECTIONS and not re.fullmatch("[A-Z0-9]{3}", identifier):
        return None
    return PREFIXES.get(identifier[:2]) if re.fullmatch("[A-Z]{2}[0-9]*", identifier) else None


def allowed_quality(parts: tuple[Part, ...], part: Part) -> tuple[str, ...]:
    """The quality codes that leave a part's value: those of its quality part, else its own, else all."""
    of = parts[part.quality - 1].allowed if part.quality and part.quality <= len(parts) else None
    return of or part.allowed or QUALITY


def implied_width(identifier: str, part: Part) -> int | None:
    """Digits of a numeric part of additional data, as many as its sentinels have."""
    if part.kind != "numeric" or identifier[:2] not in ADDITIONAL or not part.sentinels:
        return None
    sizes = {len(s) for s in part.sentinels}
    return sizes.pop() if len(sizes) == 1 else None
