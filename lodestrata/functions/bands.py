"""Bands and classes of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, bounds: list[float], names: list[str]) -> Column:
    """The name of the first bound that the value is below; the last name from the last bound on; null for null."""
    out = F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds, names, strict=False))):
        out = F.when(value < bound, F.lit(name)).otherwise(out)
    return F.when(value.isNotNull(), out)


def hhi_band(value: Column) -> Column:
    return band(value, [1500, 2500], ["non concentrato", "moderatamente concentrato", "altamente concentrato"])


def index_band(value: Column) -> Column:
    return band(value, [25, 50, 75], ["basso", "moderato", "alto", "molto alto"])


def coverage_band(percent: Column) -> Column:
    return band(percent, [50, 80], ["bassa", "media", "alta"])


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole rounded; 0 where there is nothing."""
    return F.when(whole > 0, F.round(100.0 * part / whole, digits)).otherwise(F.lit(0.0))


def status_band(status: Column) -> Column:
    s = status.cast("int")
    return F.when(s.between(200, 299), "2xx").when(s.between(300, 399), "3xx").when(s.between(400, 499), "4xx").when(s.between(500, 599), "5xx").when(s.isNull(), "nessuna_risposta").otherwise("altro")
