"""Published resources: normalising their metadata and choosing the archives to load.

All operators take and return DataFrames. The input columns are those of ``RESOURCE_SCHEMA`` plus
``posicion``, the order of listing, which decides between equal candidates.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.schemas import RESOURCE_SCHEMA

_FIELDS = [field.name for field in RESOURCE_SCHEMA]
_JSON_RESOURCE = T.StructType([*RESOURCE_SCHEMA.fields, T.StructField("description", T.StringType())])
_JSON_PACKAGE = T.StructType(
    [
        T.StructField(
            "result", T.StructType([T.StructField("resources", T.ArrayType(_JSON_RESOURCE))])
        )
    ]
)

NO_ZIP = "No resource is a ZIP archive."
NO_ZIP_FOR_DATE = "No ZIP resource for "
NO_DATES = "No ZIP resource has a date."


def read_package(spark: SparkSession, path: str) -> DataFrame:
    """Resources of saved package descriptions (JSON documents), in the order of file names and listings.

    The order has one row per resource in a single task: descriptions, not data.
    """
    packages = spark.read.schema(_JSON_PACKAGE).json(path, multiLine=True)
    listed = packages.select(F.col("_metadata.file_path").alias("archivo"), F.posexplode("result.resources").alias("orden", "r"))
    place = F.row_number().over(Window.orderBy("archivo", "orden")) - 1
    return normalized(listed.select(place.alias("posicion"), "r.*"))


def normalized(raw: DataFrame) -> DataFrame:
    """Missing texts become empty; a missing name falls back to the description."""
    blank = F.lit("")
    name = F.coalesce(F.nullif(F.col("name"), blank), F.col("description"), blank)
    return raw.select(
        "posicion",
        F.coalesce("id", blank).alias("id"),
        name.alias("name"),
        F.coalesce("format", blank).alias("format"),
        F.coalesce("url", blank).alias("url"),
        "created",
        "metadata_modified",
        "last_modified",
    )


def is_zip() -> Column:
    return (F.lower("format") == "zip") | F.lower("url").endswith(".zip")


def date_in_text(column: str) -> Column:
    """The first free-standing ``20yy-mm-dd``, if it is a real date."""
    # No match gives an empty text, which is no date either.
    return F.regexp_extract(F.col(column), r"(?U)\b(20\d{2}-\d{2}-\d{2})\b", 1).try_cast("date")


def metadata_time() -> Column:
    """Time of the last known change; the first non-empty field counts, readable or not."""
    text = F.coalesce(
        *[F.nullif(F.col(c), F.lit("")) for c in ("last_modified", "metadata_modified", "created")]
    )
    # A full date is required; a cast alone would also read '2026' or '2026-05'.
    return F.when(text.rlike(r"\A\d{4}-\d{2}-\d{2}([T ]|\z)"), F.try_to_timestamp(text))


def dated(resources: DataFrame) -> DataFrame:
    """ZIP resources with a URL, with their publication date and the two parts of their rank."""
    return (
        resources.where(is_zip() & (F.col("url") != ""))
        .withColumn("fecha_nombre", date_in_text("name"))
        .withColumn("momento", metadata_time())
        .withColumn(
            "fecha", F.coalesce("fecha_nombre", date_in_text("url"), F.to_date("momento"))
        )
    )


def _newest_first() -> list[Column]:
    return [F.col("momento").desc_nulls_last(), F.col("fecha_nombre").desc_nulls_last(), F.col("posicion").asc()]


def _newest(candidates: DataFrame, error: Column) -> DataFrame:
    """The newest candidate as the only row; fails when executed without one.

    One partial aggregate: every task keeps its best row. Missing times sort below all others because
    NULL is the smallest value inside a struct.
    """
    rank = F.struct("momento", "fecha_nombre", (-F.col("posicion")).alias("orden"))
    best = candidates.agg(F.max_by(F.struct(*_FIELDS), rank).alias("r"))
    return best.select(F.when(F.col("r").isNull(), F.raise_error(error)).otherwise(F.col("r")).alias("r")).select("r.*")


def latest(resources: DataFrame) -> DataFrame:
    """The most recent ZIP resource by metadata time, then by the date in its name."""
    return _newest(dated(resources), F.lit(NO_ZIP))


def for_date(resources: DataFrame, when: date | str) -> DataFrame:
    """The most recent ZIP resource of one publication date."""
    day = F.lit(str(when)).cast("date")
    return _newest(dated(resources).where(F.col("fecha") == day), F.lit(f"{NO_ZIP_FOR_DATE}{when}."))


def _one_per_date(candidates: DataFrame) -> DataFrame:
    order = Window.partitionBy("fecha").orderBy(*_newest_first())
    return (
        candidates.withColumn("puesto", F.row_number().over(order))
        .where(F.col("puesto") == 1)
        .select("fecha", *_FIELDS)
        .orderBy("fecha")
    )


def between_dates(resources: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """The most recent ZIP resource of every date in an inclusive range, in date order."""
    if date.fromisoformat(str(start)) > date.fromisoformat(str(end)):
        raise ValueError(f"the range ends ({end}) before it starts ({start})")
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    return _one_per_date(dated(resources).where(F.col("fecha").between(first, last)))


def recent(resources: DataFrame, days: int, reference_date: date | str | None = None) -> DataFrame:
    """One ZIP resource per date over the last ``days`` calendar days up to the newest (or given) date."""
    if days < 1:
        raise ValueError(f"at least one day is needed, not {days}")
    candidates = dated(resources)
    newest = candidates.agg(F.max("fecha").alias("fin")).select(
        F.when(F.col("fin").isNull(), F.raise_error(F.lit(NO_DATES)).cast("date")).otherwise(F.col("fin"))
    )
    end = newest.scalar() if reference_date is None else F.lit(str(reference_date)).cast("date")
    return _one_per_date(candidates.where(F.col("fecha").between(F.date_sub(end, days - 1), end)))


def available_dates(resources: DataFrame) -> DataFrame:
    """Publication dates with at least one ZIP resource, ascending."""
    return dated(resources).where(F.col("fecha").isNotNull()).select("fecha").distinct().orderBy("fecha")
