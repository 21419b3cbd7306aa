"""Weather: categories, ceilings, units and missing markers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES_PER_MILE = 1609.344
CATEGORIES = ("VFR", "MVFR", "IFR", "LIFR")
#: Covers that make a ceiling, and markers of a missing number.
CEILING_COVERS = ("BKN", "OVC", "VV")
MISSING = ("M", "T", "")
#: Factor from each reported unit to the wanted one; None leaves the unit out.
UNITS = {
    "degC": {"degC": 1.0},
    "kmh": {"km_h-1": 1.0, "km_h": 1.0, "m_s-1": 3.6},
    "deg": {"degree_(angle)": 1.0},
    "m": {"m": 1.0},
    "mm": {"mm": 1.0, "m": 1000.0},
    "ft": {"ft": 1.0, "m": 3.28084},
}


def category(ceiling_ft: Column, visibility_mi: Column) -> Column:
    """Flight category of ceiling and visibility; a missing one is unlimited, both missing give null."""
    both = lambda c, v: F.coalesce(ceiling_ft < c, F.lit(False)) | F.coalesce(visibility_mi < v, F.lit(False))
    marginal = F.coalesce(ceiling_ft <= 3000, F.lit(False)) | F.coalesce(visibility_mi <= 5, F.lit(False))
    known = ceiling_ft.isNotNull() | visibility_mi.isNotNull()
    return F.when(both(500, 1), "LIFR").when(both(1000, 3), "IFR").when(marginal, "MVFR").when(known, "VFR")


def category_metric(ceiling_ft: Column, visibility_m: Column) -> Column:
    return category(ceiling_ft, visibility_m / METRES_PER_MILE)


def severity(cat: Column) -> Column:
    """0 for VFR up to 3 for LIFR; null for anything else."""
    return F.when(cat.isin(*CATEGORIES), F.array_position(F.array(*map(F.lit, CATEGORIES)), cat) - 1)


def category_of(sev: Column) -> Column:
    return F.get(F.array(*map(F.lit, CATEGORIES)), sev.cast("int"))


def rank_in(col: Column, *values: str) -> Column:
    """Position in a custom order, for sorting; 0 if absent."""
    return F.array_position(F.array(*map(F.lit, values)), col)


def number(text: Column) -> Column:
    """A reported number; missing markers and anything unreadable give null."""
    return F.when(~F.trim(text).isin(*MISSING), F.trim(text)).try_cast("double")


def ceiling_slots(covers: list[Column], bases: list[Column]) -> Column:
    """Lowest base among the slots whose cover makes a ceiling."""
    return F.array_min(F.array(*[F.when(F.trim(c).isin(*CEILING_COVERS), number(b)) for c, b in zip(covers, bases, strict=True)]))


def ceiling_layers(layers: Column) -> Column:
    """Lowest base in feet among an array of cloud layers (base: value and unit, amount)."""
    cloud = F.filter(layers, lambda x: F.upper(x["amount"]).isin(*CEILING_COVERS))
    return F.array_min(F.transform(cloud, lambda x: convert(x["base"], "ft")))


def convert(quantity: Column, unit: str) -> Column:
    """A {value, unitCode} struct in the wanted unit; an unknown unit gives null."""
    code = F.element_at(F.split(quantity["unitCode"], ":", 2), -1)
    out = F.lit(None).cast("double")
    for name, factor in UNITS[unit].items():
        out = F.when(code == name, quantity["value"].cast("double") * factor).otherwise(out)
    return out


def effective_wind(gust: Column, speed: Column) -> Column:
    return F.coalesce(gust, speed)


def wind_bucket(wind: Column) -> Column:
    return F.when(wind.isNull(), "unknown").when(wind > 37, "windy").when(wind >= 20, "breezy").otherwise("calm")
