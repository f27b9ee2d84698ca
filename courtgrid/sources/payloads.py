"""Landed API payloads: schemas, scan and envelope handling.

HTTP polling is not part of this library: the API responses are landed
as JSON files (one response per file, or JSON lines) and read here with an
explicit schema, so no inference pass scans the data.  Every reader adds
``_file`` and ``_pos`` (position of the record inside its response) so the
order-sensitive dedupe rules (W5–W7) have a real input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

# --- payload record schemas (DDL) -------------------------------------------
A_RESERVATION = (
    "Id STRING, ReservationTypeId STRING, ReservationTypeName STRING, StartTime STRING, EndTime STRING, "
    "CreatedOnUtc STRING, UpdatedOnUtc STRING, CancelledOnUtc STRING, CancelledOn STRING, Courts STRING, "
    "Players ARRAY<STRUCT<OrganizationMemberId: STRING>>"
)
A_CANCELLATION = (
    "EventId STRING, EventDateId STRING, OrganizationMemberId STRING, StartTime STRING, EndTime STRING, "
    "SignedUpOnUtc STRING, CancelledOnUtc STRING, CancelledOn STRING, FirstName STRING, LastName STRING, "
    "Email STRING, Phone STRING, EventName STRING, EventCategoryName STRING, EventCategoryId BIGINT, "
    "PriceToPay DOUBLE, IsTeamEvent BOOLEAN"
)
A_MEMBER = (
    "MembershipNumber STRING, FirstName STRING, LastName STRING, Gender STRING, DateOfBirth STRING, "
    "Email STRING, PhoneNumber STRING, MobilePhone STRING, MembershipTypeName STRING, "
    "MembershipStartDate STRING, Staff BOOLEAN, IsStaff BOOLEAN"
)
A_EVENT = (
    "Id STRING, EventId STRING, Name STRING, EventName STRING, "
    "EventCategoryId BIGINT, EventCategoryName STRING, CategoryName STRING, EventType STRING, "
    "TimeZone STRING, StartTime STRING, StartDateTime STRING, "
    "EndTime STRING, EndDateTime STRING, MaxRegistrants STRING, RegisteredCount STRING, "
    "PriceInfo ARRAY<STRUCT<MembershipTypeName: STRING, DailyPrice: DOUBLE, EntireEventPrice: DOUBLE>>, "
    "Courts ARRAY<STRUCT<Id: BIGINT, Label: STRING, TypeName: STRING, OrderIndex: INT>>"
)
# Keys that differ from A_EVENT keys only by case.  Spark resolves column
# names case-insensitively, so :func:`parse_records` parses them in the same
# pass and moves them into a separate ``_alt`` struct by a renaming cast.
A_EVENT_ALT = "id STRING, name STRING, startTime STRING, endTime STRING, Timezone STRING"

_B_PERSON = ("STRUCT<id: STRING, email: STRING, phoneNumber: STRING, firstName: STRING, lastName: STRING, "
             "displayName: STRING, fullName: STRING>")
B_EVENT = (
    "id STRING, type STRING, subtype STRING, name STRING, title STRING, description STRING, "
    "startTime STRING, start_time STRING, endTime STRING, end_time STRING, timezone STRING, "
    "totalTeams STRING, teamSize STRING, signups STRUCT<_total: STRING>, "
    "admissionRate STRUCT<regular: STRING, member: STRING>, "
    "invitations STRUCT<items: ARRAY<STRUCT<status: STRING, inviteeProfile: STRUCT<id: STRING>, "
    "invitee: STRUCT<email: STRING, phoneNumber: STRING>>>>, "
    "reservations STRUCT<items: ARRAY<STRUCT<id: STRING, code: STRING, startTime: STRING, endTime: STRING, "
    f"createdAt: STRING, updatedAt: STRING, cancelledAt: STRING, bookedById: STRING, bookedBy: {_B_PERSON}, "
    f"_embedded: STRUCT<bookedBy: {_B_PERSON}>>>>"
)
B_SESSION = (
    "id STRING, startTime STRING, endTime STRING, periodType STRING, status STRING, "
    "availableTables STRUCT<items: ARRAY<STRUCT<type: STRING, table: STRUCT<id: STRING, "
    "displayName: STRING, displayNameShort: STRING>>>>"
)
B_USER = (
    "id STRING, firstName STRING, lastName STRING, gender STRING, birthday STRING, email STRING, "
    "membershipType STRING, phoneNumber STRING, profile STRUCT<memberSince: STRING>, "
    "memberships STRUCT<items: ARRAY<STRUCT<createdAt: STRING, startedAt: STRING, "
    "membership: STRUCT<id: STRING, createdAt: STRING>>>>"
)
PLACE = (
    "id STRING, rating DOUBLE, userRatingCount INT, "
    "reviews ARRAY<STRUCT<name: STRING, rating: DOUBLE, text: STRUCT<text: STRING>, publishTime: STRING>>, "
    "photos ARRAY<STRUCT<name: STRING>>"
)


def envelope_a(record_schema: str, members: bool = False) -> str:
    """System-A envelope ``{ErrorMessage, Data, IsSuccessStatusCode}``;
    ``Data`` is the list, or ``{Members: list}`` for members."""
    data = f"STRUCT<Members: ARRAY<STRUCT<{record_schema}>>>" if members else f"ARRAY<STRUCT<{record_schema}>>"
    return f"ErrorMessage STRING, IsSuccessStatusCode BOOLEAN, Data {data}"


def envelope_b(record_schema: str) -> str:
    """System-B envelope ``{items, _total}``."""
    return f"items ARRAY<STRUCT<{record_schema}>>, _total BIGINT"


def read_landed(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    """Landed responses with an explicit schema, plus ``_file``.

    A response that is not JSON becomes a row of nulls: its status flag is null,
    so :func:`split_status_a` sends it to the rejects."""
    return (spark.read.schema(schema).option("multiLine", multiline).json(path)
            .withColumn("_file", F.col("_metadata.file_path")))


def split_status_a(env: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: (good responses, rejected responses).  A response is rejected when
    ``ErrorMessage`` is set or ``IsSuccessStatusCode`` is not true: an absent or
    null flag, or an unreadable response, is a reject too.  Every response is in
    one of the two."""
    bad = ((F.coalesce(F.col("ErrorMessage"), F.lit("")) != "")
           | ~F.coalesce(F.col("IsSuccessStatusCode"), F.lit(False)))
    return env.filter(~bad), env.filter(bad)


def split_status_b(env: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3 for system B: a response without its ``items`` list (also an unreadable
    one) is rejected; an empty list is good."""
    return env.filter(F.col("items").isNotNull()), env.filter(F.col("items").isNull())


def bad_times(fields, within: str = "") -> Column:
    """Does one of the time texts name no time?  An absent, null or empty text is
    no fault.  ``a.items[].b`` is field ``b`` of every element of the list ``a.items``;
    ``within`` is a struct that holds the fields."""
    texts = F.array(*[F.col(within + f) for f in fields if "[]." not in f]).cast("array<string>")
    nested = [f.split("[].") for f in fields if "[]." in f]
    lists = [F.coalesce(F.col(f"{within}{at}.{leaf}"), F.array().cast("array<string>")) for at, leaf in nested]
    # one test over all texts of a record, not one copy of it for each field
    return F.exists(F.concat(texts, *lists), lambda t: F.coalesce((t != "") & S.parse_iso_utc(t).isNull(), F.lit(False)))


def split_bad_times(records: DataFrame, fields) -> tuple[DataFrame, DataFrame]:
    """(records whose time texts can all be read, the others): a record must
    not be loaded with a null time in place of a text that is no time."""
    bad = bad_times(fields)
    return records.filter(~bad), records.filter(bad)


def fail_on_rejects(rejected: DataFrame) -> DataFrame:
    """S3 strict mode: a projection that raises inside the job if any
    rejected response exists (no driver round trip)."""
    return rejected.select(F.raise_error(F.concat(F.lit("API error: "),
                                                  F.coalesce("ErrorMessage", F.lit("unsuccessful")))))


def unwrap_a(env: DataFrame, members: bool = False, keep=("_file",)) -> DataFrame:
    """``Data`` (or ``Data.Members``) -> one row per record with ``_pos``."""
    arr = F.col("Data.Members") if members else F.col("Data")
    return env.select(*keep, F.posexplode(arr).alias("_pos", "_rec")).select(*keep, "_pos", "_rec.*")


def unwrap_b(env: DataFrame, keep=("_file",)) -> DataFrame:
    """``items`` -> one row per record with ``_pos``."""
    return env.select(*keep, F.posexplode("items").alias("_pos", "_rec")).select(*keep, "_pos", "_rec.*")


def parse_records(text_df: DataFrame, text_col: str, schema: str, keep=(), alt_schema: str | None = None) -> DataFrame:
    """Records held as JSON text in a column (e.g. a landed table) -> struct
    columns; keys that clash by case go to the ``_alt`` struct.

    The parse runs inside a generator (``inline`` of a one-element array).
    Filters on the parsed fields cannot be pushed below a generator, so
    Catalyst cannot copy ``from_json`` into every pushed-down predicate:
    each record is decoded exactly once."""
    if not alt_schema:
        return text_df.select(*keep, F.inline(F.array(F.from_json(F.col(text_col), schema))))
    main = T.StructType.fromDDL(schema)
    alt = T.StructType.fromDDL(alt_schema)
    both = T.StructType(main.fields + alt.fields)
    renamed = T.StructType(main.fields + [T.StructField(f"_alt_{f.name}", f.dataType) for f in alt.fields])
    out = text_df.select(*keep, F.inline(F.array(F.from_json(F.col(text_col), both).cast(renamed))))
    return out.select(*keep, *[f.name for f in main.fields],
                      F.struct(*[F.col(f"_alt_{f.name}").alias(f.name) for f in alt.fields]).alias("_alt"))


def read_landed_text(spark: SparkSession, path: str, schema: str, alt_schema: str | None = None) -> DataFrame:
    """S1 for payloads whose keys differ only by case: read each file whole
    as text, then parse (one record per line in JSON-lines files)."""
    raw = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path"))
    return parse_records(raw.filter(F.trim("value") != ""), "value", schema, keep=("_file",), alt_schema=alt_schema)


def sample(df: DataFrame, n: int | None, order_by) -> DataFrame:
    """Dev sample of ``n`` rows; ordered so the sample repeats."""
    if not n:
        return df
    return df.orderBy(*order_by).limit(int(n))
