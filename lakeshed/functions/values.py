"""Numbers, dates, places, hashes, arrays and JSON values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


# Numbers -------------------------------------------------------------------


def price(x: Column) -> Column:
    """The first number of a text like ``AED 48.5``."""
    return F.regexp_extract(F.replace(x, F.lit(","), F.lit("")), r"\d+\.?\d*", 0).try_cast("double")


def percent_change(before: Column, after: Column) -> Column:
    """(after - before) / before in percent, two digits; null where there is nothing to divide by."""
    return F.round((after - before) / F.nullif(before, F.lit(0.0)) * 100, 2)


def is_outlier(change: Column, most: float = 300.0) -> Column:
    return F.coalesce(F.abs(change) > most, F.lit(False))


def differs(a: Column, b: Column, by: float = 0.01) -> Column:
    return F.abs(a - b) > by


def number_range(x: Column) -> Column:
    """struct(least, most) of the numbers in a text like ``1,200-1,500``."""
    found = F.transform(F.regexp_extract_all(F.replace(x, F.lit(","), F.lit("")), F.lit(r"\d+"), F.lit(0)), lambda n: n.try_cast("long"))
    return F.struct(F.array_min(found).alias("least"), F.array_max(found).alias("most"))


def from_range(x: Column, least: Column, most: Column) -> Column:
    """0 inside the range, else the signed distance to it."""
    return F.when(x < least, x - least).when(x > most, x - most).otherwise(F.lit(0))


def band(x: Column, cuts: list[tuple[float, str]], last: str) -> Column:
    """The name of the first cut that is above the value."""
    out = F.lit(last)
    for limit, name in reversed(cuts):
        out = F.when(x < limit, F.lit(name)).otherwise(out)
    return F.when(x.isNotNull(), out)


def finite(x: Column) -> Column:
    """NaN and infinities are null."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def price_issue(x: Column, most: float) -> Column:
    """What is wrong with a price; null if nothing is."""
    return F.when(x.isNull(), "missing").when(x < 0, "negative").when(x == 0, "zero").when(x > most, "too high")


# Dates ---------------------------------------------------------------------


def long_date(x: Column) -> Column:
    """``June 2, 2026`` as a date."""
    return F.try_to_timestamp(x, F.lit("MMMM d, yyyy")).cast("date")


def days_between(before: Column, after: Column) -> Column:
    return F.round((F.unix_micros(after) - F.unix_micros(before)) / F.lit(86_400_000_000.0), 2)


MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def month_of_path(path: Column, year: int) -> Column:
    """yyyymm of the month that a path names."""
    out = F.lit(None).cast("int")
    for k, name in enumerate(MONTHS, 1):
        out = F.when(F.lower(path).rlike(rf"(^|[^a-z]){name}([^a-z]|$)"), F.lit(year * 100 + k)).otherwise(out)
    return out


# Places --------------------------------------------------------------------


def metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if a coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees times 111, as the city vote measures."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2)) * 111


def or_far(distance: Column) -> Column:
    """Infinity where the distance is unknown, so that it never matches."""
    return F.coalesce(distance, F.lit(float("inf")))


def grid(x: Column, digits: int) -> Column:
    """The cell of a coordinate at so many decimal digits."""
    return F.floor(x * 10**digits)


def lat_lng(x: Column) -> Column:
    """struct(lat, lng) of ``25.2, 55.3``."""
    parts = F.split(x, ",")
    return F.struct(F.trim(F.get(parts, F.lit(0))).try_cast("double").alias("lat"), F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("lng"))


def region(lat: Column, lon: Column, boxes: list[tuple[float, float, float, float, str]], default: str = "Unknown") -> Column:
    """The name of the first box (south, north, west, east) that holds the point; 0,0 and nulls are unknown."""
    out = F.lit(default)
    for south, north, west, east, name in reversed(boxes):
        out = F.when(lat.between(south, north) & lon.between(west, east), F.lit(name)).otherwise(out)
    return F.when(lat.isNull() | lon.isNull() | ((lat == 0) & (lon == 0)), F.lit(default)).otherwise(out)


# Hashes --------------------------------------------------------------------


def id52(x: Column) -> Column:
    """The first 13 hex digits of sha-256 as a number: a stable id below 2**52."""
    return F.conv(F.substring(F.sha2(x, 256), 1, 13), 16, 10).cast("long")


def review_id(x: Column) -> Column:
    return F.concat(F.lit("MK-"), F.substring(F.sha2(x, 256), 1, 12))


def group_key(x: Column) -> Column:
    return F.substring(F.sha1(x), 1, 10)


# Arrays --------------------------------------------------------------------


def same_items(a: Column, b: Column) -> Column:
    return F.array_sort(a).eqNullSafe(F.array_sort(b))


def overlap_share(a: Column, b: Column) -> Column:
    """The share of the first array's items that the second holds."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def listed(x: Column) -> Column:
    """An array from a text that holds a JSON list or values with commas."""
    trimmed = F.trim(x)
    return F.when(F.startswith(trimmed, F.lit("[")), F.from_json(trimmed, "array<string>")).otherwise(F.filter(F.transform(F.split(trimmed, ","), lambda s: F.trim(s)), lambda s: s != ""))


# JSON and fallbacks --------------------------------------------------------


def first_filled(*options: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.trim(o), F.lit("")) for o in options])


def translated(x: Column, words: list[tuple[str, str]]) -> Column:
    """A value's translation: a whole hit first, else every listed part in the list's order."""
    whole, parts = F.lit(None).cast("string"), x
    for source, target in reversed(words):
        whole = F.when(x == source, F.lit(target)).otherwise(whole)
    for source, target in words:
        parts = F.replace(parts, F.lit(source), F.lit(target))
    return F.coalesce(whole, parts)
