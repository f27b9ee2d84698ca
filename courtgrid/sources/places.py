"""Place details (N18–N20) and the review aggregate load (M3 on reviews)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
REVIEW_LINK_PREFIX = "https://www.google.com/maps/place/?q=place_id:"
PLACES_API_BASE = "https://places.googleapis.com/v1"
REVIEW_SERVICE = "google"
PHOTO_MAX_WIDTH = 800


def review_columns():
    """N18 columns: review service, count, average, link built from the place id."""
    return [F.lit(REVIEW_SERVICE).alias("review_service"),
            F.col("userRatingCount").alias("num_reviews"), F.col("rating").alias("avg_review"),
            F.concat(F.lit(REVIEW_LINK_PREFIX), F.col("id")).alias("link_to_reviews")]


def photo_columns(max_width: int = PHOTO_MAX_WIDTH):
    """N19 columns: first photo name and its media URL (null without photos)."""
    name = F.try_element_at(F.col("photos"), F.lit(1))["name"]
    return [name.alias("photo_name"),
            F.when(name.isNotNull(), F.format_string(f"{PLACES_API_BASE}/%s/media?maxWidthPx={int(max_width)}",
                                                     name)).alias("photo_url")]


def review_aggregate(places: DataFrame) -> DataFrame:
    """(client_code, review_service, num_reviews, avg_review, link) per
    place; ``places`` carries client_code and the place details."""
    return places.select("client_code", *review_columns(), *[c for c in ("_file", "_pos") if c in places.columns])


def first_photo(places: DataFrame, max_width: int = PHOTO_MAX_WIDTH) -> DataFrame:
    """First photo name and its media URL (null without photos)."""
    return places.select("client_code", F.col("id").alias("place_id"), *photo_columns(max_width))


def reviews(places: DataFrame) -> DataFrame:
    """One row per review of a place."""
    return places.select("client_code", F.col("id").alias("place_id"), F.explode("reviews").alias("review")) \
        .select("client_code", "place_id", "review.*")
