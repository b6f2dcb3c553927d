"""Column expressions shared by the layers and the reports. All run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371

# Band edges with their labels, period edges with their labels, class labels.
AMOUNT_BANDS = [
    (10, "1. até 10"),
    (50, "2. 10 a 50"),
    (100, "3. 50 a 100"),
    (250, "4. 100 a 250"),
    (500, "5. 250 a 500"),
    (1000, "6. 500 a 1000"),
    (None, "7. acima de 1000"),
]
VALUE_BANDS = [
    (50, "1. até 50"),
    (250, "2. 50 a 250"),
    (1000, "3. 250 a 1000"),
    (None, "4. acima de 1000"),
]
DAY_PERIODS = [(6, "madrugada"), (12, "manhã"), (18, "tarde"), (None, "noite")]
CLASS_LABELS = {0: "legítima", 1: "fraude"}


def event_time(date: str = "trans_date", time: str = "trans_time") -> Column:
    """Timestamp of two text columns; null when either is missing or malformed."""
    return F.try_to_timestamp(F.concat(F.col(date), F.lit(" "), F.col(time)))


def hashed(col: str, salt: str | None = None) -> Column:
    """SHA-256 hex of the value as text. A secret ``salt`` stops a search of small key spaces."""
    text = F.col(col).cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def age_at(event: str | Column = "event_time", born: str | Column = "dob") -> Column:
    """Completed years between a birth date (text or date) and an event."""
    born = F.col(born) if isinstance(born, str) else born
    return F.floor(F.months_between(event, born.try_cast("date")) / 12)


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str, digits: int = 2) -> Column:
    """Great-circle distance; the clamp keeps antipodal points inside the domain of asin."""
    phi1, phi2 = F.radians(F.col(lat1)), F.radians(F.col(lat2))
    half_lat = (phi2 - phi1) / 2
    half_lon = F.radians(F.col(lon2) - F.col(lon1)) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(half_lon), F.lit(2)
    )
    arc = EARTH_RADIUS_KM * 2 * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    return F.round(arc, digits)


def calendar_features(ts: str | Column = "event_time") -> dict[str, Column]:
    """``hour``, ``day_of_week`` (1 = Sunday) and ``month``."""
    return {"hour": F.hour(ts), "day_of_week": F.dayofweek(ts), "month": F.month(ts)}


def epoch_seconds(ts: str | Column = "event_time") -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("timestamp").cast("long")


def banded(col: str, bands: list[tuple[float | None, str]]) -> Column:
    """Label of the first band whose upper edge lies above the value; the last edge is None."""
    *closed, (_, rest) = bands
    (edge, label), *others = closed
    out = F.when(F.col(col) < edge, label)
    for edge, label in others:
        out = out.when(F.col(col) < edge, label)
    return out.otherwise(rest)


def amount_band(col: str = "amt") -> Column:
    return banded(col, AMOUNT_BANDS)


def decade(col: str = "age") -> Column:
    return F.floor(F.col(col) / 10) * 10


def class_label(col: str = "is_fraud") -> Column:
    pairs = [F.lit(x) for item in CLASS_LABELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(col))


def rate_pct(target: str = "is_fraud", digits: int = 3) -> Column:
    """Aggregate: mean of a 0/1 column as a rounded percentage."""
    return F.round(F.avg(target) * 100, digits)


def hash_fraction(col: str | Column) -> Column:
    """Number in [0, 1) fixed by the text of the value, whatever the partitioning."""
    col = F.col(col) if isinstance(col, str) else col
    digest = F.sha2(col.cast("string"), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def decision(score: str | Column, threshold: float | Column) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= threshold).cast("int")
