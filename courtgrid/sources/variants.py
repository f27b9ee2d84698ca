"""Landed responses and their records as VARIANT.

A response is decoded once with ``try_parse_json``; its records are variants taken
out of it, so no record is written back to text and parsed again.  A record's fields
come from one cast of its variant to the declared struct, which is exact about the
case of keys: ``Id`` and ``id`` are two fields.  Ids are declared STRING and may be
of any JSON type.  Keys that the schema does not name are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

# Where a response keeps its records, by envelope.
ITEMS = {"a": "$.Data", "a_members": "$.Data.Members", "b": "$.items"}


def folder_value(path: Column, key: str) -> Column:
    """Value of a ``key=value`` folder in a file's path, null where there is none."""
    part = F.regexp_extract(path, rf"/{key}=([^/]*)/", 1)
    return F.nullif(F.url_decode(F.url_decode(F.replace(part, F.lit("+"), F.lit("%252B")))), F.lit(""))


def responses(reader, landing: str, multiline: bool = True) -> DataFrame:
    """Landed responses of a batch or stream reader: value, client_code, poll, file, at.

    A file is one response, or (``multiline=False``) one response a line.  Tenant and
    poll come from the folders ``client_code=..`` and ``poll=..``, in any order; without
    a poll folder ``poll`` is null."""
    df = reader.schema("value STRING").option("wholetext", multiline).option("recursiveFileLookup", True).text(landing)
    path = F.col("_metadata.file_path")
    return df.select("value", F.lower(S.py_strip(folder_value(path, "client_code"))).alias("client_code"),
                     folder_value(path, "poll").alias("poll"), path.alias("file"),
                     F.col("_metadata.file_modification_time").alias("at"))


def unwrap(df: DataFrame, envelope: str, value: str = "value") -> DataFrame:
    """S2 + S3: the columns of ``df`` and, for each record of a response, its place ``i``
    and variant ``v``; a good response without records and a bad one give one row
    without a place.  ``ok`` is the status: system A must not name an error and must
    set its flag, system B must have its list, a place must have an id."""
    keep = [F.col(c) for c in df.columns]
    env = df.select(*keep, F.inline(F.array(F.struct(F.try_parse_json(value).alias("env")))))
    if envelope == "place":
        ok, items = F.try_variant_get("env", "$.id", "string").isNotNull(), F.array("env")
    else:
        items = F.try_variant_get("env", ITEMS[envelope], "array<variant>")
        ok = items.isNotNull() if envelope == "b" else (
            (F.coalesce(F.try_variant_get("env", "$.ErrorMessage", "string"), F.lit("")) == "")
            & F.coalesce(F.try_variant_get("env", "$.IsSuccessStatusCode", "boolean"), F.lit(False)))
    return (env.select(*keep, F.coalesce(ok, F.lit(False)).alias("ok"), items.alias("items"))
            .select(*keep, "ok", F.posexplode_outer(F.when(F.col("ok"), F.col("items"))).alias("i", "v")))


def records(df: DataFrame, schema: str, alt_schema: str | None = None, column: str = "v") -> DataFrame:
    """The columns of ``df`` less the variant, the struct ``f`` of the declared fields and
    ``fault``: null, ``record`` (not an object) or ``field type``.

    ``alt_schema`` names fields that differ from those of ``schema`` only by case; they
    are the struct ``_alt`` in ``f``, for readers that do not tell cases apart.  A field of
    another type than STRING whose value cannot be read as that type is a fault; a null or
    absent one is not."""
    main = T.StructType.fromDDL(schema)
    alt = T.StructType.fromDDL(alt_schema) if alt_schema else T.StructType([])
    both = T.StructType(main.fields + alt.fields)
    plain = T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(both.fields)])
    keep = [F.col(c) for c in df.columns if c != column]
    # positional names: fields that differ by case alone cannot be told apart by name
    cast = F.try_variant_get(column, "$", both.simpleString()).cast(plain)
    typed = [F.when(F.col(f"r.f{i}").isNull(), F.try_variant_get(column, f"$.{f.name}", "string").isNotNull())
             for i, f in enumerate(both.fields) if not isinstance(f.dataType, T.StringType)]
    out = df.select(*keep, column, F.inline(F.array(F.struct(cast.alias("r")))))
    fault = F.when(F.col(column).isNotNull() & F.col("r").isNull(), "record")
    for wrong in typed:
        fault = fault.when(wrong, "field type")
    fields = [F.col(f"r.f{i}").alias(f.name) for i, f in enumerate(main.fields)]
    if alt_schema:
        fields.append(F.struct(*[F.col(f"r.f{len(main.fields) + i}").alias(f.name)
                                 for i, f in enumerate(alt.fields)]).alias("_alt"))
    return out.select(*keep, F.when(F.col("r").isNotNull(), F.struct(*fields)).alias("f"), fault.alias("fault"),
                      column)
