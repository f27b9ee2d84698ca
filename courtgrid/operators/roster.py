"""Tenant rosters, place roster, seeds and small lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import merge as M


def tenant_roster(organizations: DataFrame, system: str) -> DataFrame:
    """Customers of one booking system, code stripped and lower-cased,
    with the pod id (empty = null).  Loads semi-join it; nothing is collected."""
    pod = F.nullif(F.col("podplay_pod_id"), F.lit("")) if "podplay_pod_id" in organizations.columns \
        else F.lit(None).cast("string")
    return organizations.filter(
        F.col("is_customer") & (F.col("source_system_code") == system) & (F.coalesce("client_code", F.lit("")) != "")
    ).select(F.lower(S.py_strip(F.col("client_code"))).alias("client_code"), pod.alias("pod_id"))


def place_roster(organizations: DataFrame) -> DataFrame:
    """Facilities that have a place id."""
    return organizations.filter(F.col("google_place_id").isNotNull()).select("client_code", "google_place_id")


def courts_in_order(courts: DataFrame) -> DataFrame:
    """O2: courts by tenant and ``order_index`` (null last, ties by id)."""
    return courts.orderBy("client_code", F.col("order_index").asc_nulls_last(), "id")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A seed table as CSV with a header, under an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def seed(current: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert seed rows on ``keys``; running it twice changes nothing."""
    return M.upsert(current, rows, list(keys))


def member_count(members: DataFrame) -> DataFrame:
    """Number of member rows."""
    return members.agg(F.count(F.lit(1)).alias("n_members"))
