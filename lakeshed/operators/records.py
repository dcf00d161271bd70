"""Raw place records as flat ones: projection with defaults, reasons to drop a row, category, brand, cuisine and country rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshed.functions.text import cid_only

c = F.col


def filled(x: Column) -> Column:
    """Trimmed; null is empty."""
    return F.trim(F.coalesce(x, F.lit("")))


def drop_reason(raw: DataFrame, other_kinds: DataFrame) -> DataFrame:
    """Adds ``reason``: why a record is dropped (closed, no name, other kind), null if it stays.

    ``other_kinds`` has the categories (lower case) that are no place to eat.
    """
    kinds = other_kinds.select(F.lower(F.trim("category")).alias("_kind")).distinct()
    rows = raw.withColumn("_own", F.lower(filled(c("categoryName")))).join(kinds, c("_own") == c("_kind"), "left")
    closed = F.coalesce("permanentlyClosed", F.lit(False)) | F.coalesce("temporarilyClosed", F.lit(False))
    reason = F.when(closed, "closed").when(filled(c("title")) == "", "no name").when(c("_kind").isNotNull(), "other kind")
    return rows.withColumn("reason", reason).drop("_own", "_kind")


def reasons(dropped: DataFrame) -> DataFrame:
    """(reason, n): how many records each reason drops; those that stay are ``kept``."""
    return dropped.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def place_records(raw: DataFrame, types: DataFrame, area: str = "") -> DataFrame:
    """The flat record of each raw one; ``types`` maps a category (lower case) to its type, others are ``Other``."""
    known = types.groupBy(F.lower(F.trim("category")).alias("_kind")).agg(F.min("type").alias("_type"))
    rows = raw.join(known, F.lower(F.trim("categoryName")) == c("_kind"), "left")
    kind = F.coalesce("categoryName", F.lit(""))
    many = F.coalesce("categories", F.array().cast("array<string>"))
    stars = F.struct(*[F.coalesce(c(f"reviewsDistribution.{name}Star"), F.lit(0)).cast("long").alias(f"{k}_star") for k, name in enumerate(("one", "two", "three", "four", "five"), 1)])
    texts = {"Address": "address", "Street": "street", "Neighborhood": "neighborhood", "City": "city", "Contact_No": "phone", "Website": "website"}
    return rows.select(
        F.coalesce("placeId", F.lit("")).alias("place_id"), filled(c("title")).alias("Name"), *[filled(c(x)).alias(n) for n, x in texts.items()],
        c("location.lat").alias("Geo_Lat"), c("location.lng").alias("Geo_Lng"), F.coalesce(cid_only(c("url")), F.lit("")).alias("Google_Maps_URL"), filled(c("plusCode")).alias("Plus_Code"),
        kind.alias("Category"), F.when(F.size(many) > 0, many).when(kind != "", F.array(kind)).otherwise(many).alias("All_Categories"), F.coalesce("_type", F.lit("Other")).alias("Category_Type"),
        c("totalScore").alias("Rating"), F.coalesce("reviewsCount", F.lit(0)).cast("long").alias("Review_Count"), stars.alias("Rating_Distribution"), filled(c("price")).alias("Price_Range"), filled(c("menu")).alias("Menu_URL"),
        F.coalesce("openingHours", F.array().cast("array<string>")).alias("Opening_Hours"), F.lit(area).alias("Area"), filled(c("scrapedAt")).alias("Scraped_At"), F.coalesce("permanentlyClosed", F.lit(False)).alias("Permanently_Closed"),
    )


def carries_brand(text: Column, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Whether a text holds one of the words; one of those excluded wins."""
    low = F.lower(F.coalesce(text, F.lit("")))
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, F.lower(w))) if words else F.lit(False)
    return has(list(include)) & ~has(list(exclude))


def other_business(categories: Column, pattern: str) -> Column:
    """Whether the categories together name another kind of business."""
    return F.lower(F.concat_ws(" ", categories)).rlike(pattern)


def wanted_cuisine(cuisines: Column, name: Column, wanted: Sequence[str], rescue: str) -> Column:
    """Whether one of the cuisines, split at commas, is wanted, or the name speaks for one."""
    parts = F.transform(F.split(F.coalesce(cuisines, F.lit("")), ","), lambda x: F.lower(F.trim(x)))
    return (F.size(F.array_intersect(parts, F.array(*[F.lit(w.lower()) for w in wanted]))) > 0) | F.coalesce(F.lower(name).rlike(rescue), F.lit(False))


def in_country(lat: Column, lon: Column, address: Column, box: tuple[float, float, float, float], foreign: str) -> Column:
    """Inside the box (south, north, west, east) where the place is known, and no foreign word in the address."""
    inside = lat.between(box[0], box[1]) & lon.between(box[2], box[3])
    return F.coalesce(inside, F.lit(True)) & ~F.coalesce(F.lower(address).rlike(foreign), F.lit(False))


def fanned_out(df: DataFrame, matches: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each row with all its matches, and once without where it has none; ``found`` tells them apart."""
    side = matches.select(c(key).alias("_key"), *columns, F.lit(True).alias("_hit"))
    return df.join(side, c(key) == c("_key"), "left").withColumn("found", F.when(c("_hit"), "matched").otherwise("not_found")).drop("_key", "_hit")


def reconciled(df: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """A value from the first source where its ``status`` is confirmed, else from the second where that has it, else the first's unconfirmed one; ``source`` says which."""
    a = first.select(c(key).alias("_a"), c(value).alias("_va"), c("status").alias("_sa"))
    b = second.select(c(key).alias("_b"), c(value).alias("_vb"))
    rows = df.join(a, c(key) == c("_a"), "left").join(b, c(key) == c("_b"), "left")
    sure = F.coalesce((c("_sa") == "confirmed") & c("_va").isNotNull(), F.lit(False))
    source = F.when(sure, "first").when(c("_vb").isNotNull(), "second").when(c("_va").isNotNull(), "first, unconfirmed").otherwise("none")
    picked = F.when(sure, c("_va")).otherwise(F.coalesce("_vb", "_va"))
    return rows.withColumns({value: picked, "source": source}).drop("_a", "_va", "_sa", "_b", "_vb")
