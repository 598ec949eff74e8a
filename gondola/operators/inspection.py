"""Archive inspection: file, member and row counts as aggregations over the raw scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.functions.cleaning import has_content, has_size, is_footer, stripped
from gondola.schemas import TABLES
from gondola.sources.nested_zip import MEMBER

# Messages of an inspection.
EMPTY_MEMBER = "ZIP interno vacío."
CORRUPT_MEMBER = "ZIP interno corrupto."
NOT_UTF8 = "No se pudo decodificar como UTF-8."

_HEADERS = {spec.csv: spec.header for spec in TABLES.values()}


def file_reports(raw: DataFrame) -> DataFrame:
    """One row per member and expected file, absent files included.

    The scan emits a note for every expected file of a readable member, so presence, header and row
    counts come out of a single partially aggregated pass.
    """
    fields, state = F.col("campos"), F.col("estado")
    note, row = F.col("tipo") == "csv", F.col("tipo") == "fila"

    header_ok, complete = F.lit(False), F.lit(False)
    for name, header in _HEADERS.items():
        is_file = F.col("csv") == name
        titles = F.transform(fields, stripped)
        header_ok = F.when(is_file, titles == F.array(*[F.lit(c) for c in header])).otherwise(header_ok)
        complete = F.when(is_file, has_size(fields, len(header))).otherwise(complete)

    problem = F.when(F.col("error").startswith("UnicodeDecodeError"), F.lit(NOT_UTF8)).otherwise(F.col("error"))
    keys = [*MEMBER, "archivo_origen", "csv"]
    filled, footer = F.col("lleno"), F.col("pie")
    counted = filled & ~footer
    # The message is a key first: as an argument, a text would have all rows of the scan sorted.
    parts = (
        raw.where(F.col("tipo") != "miembro")
        .withColumns({"lleno": row & has_content(fields), "problema": F.when(note, problem)})
        .withColumn("pie", filled & is_footer(fields))
        .groupBy(*keys, "problema")
        .agg(
            F.max(note & (state != "falta")).alias("present"),
            F.max(note & (state == "vacio")).alias("empty"),
            F.coalesce(F.max(F.when(note, header_ok)), F.lit(False)).alias("header_ok"),
            F.count_if(counted).alias("rows_total"),
            F.count_if(counted & complete).alias("rows_valid"),
            F.count_if(counted & ~complete).alias("rows_invalid"),
            F.count_if(footer).alias("footer_rows_removed"),
        )
    )
    return (
        parts.groupBy(*keys)
        .agg(
            *[F.max(name).alias(name) for name in ("present", "empty", "header_ok")],
            *[F.sum(name).alias(name) for name in ("rows_total", "rows_valid", "rows_invalid", "footer_rows_removed")],
            F.max("problema").alias("error"),
        )
        .drop("archivo", "orden")
    )


def member_counts(notes: DataFrame) -> DataFrame:
    """Members per archive: all, readable, empty and corrupt. Other failures are in no counter."""
    state = F.col("estado")
    return (
        notes.where(F.col("tipo") == "miembro")
        .groupBy("zip")
        .agg(
            F.count("*").alias("inner_zips_total"),
            F.count_if(state == "ok").alias("inner_zips_valid"),
            F.count_if(state == "vacio").alias("inner_zips_empty"),
            F.count_if(state == "corrupto").alias("inner_zips_corrupt"),
        )
    )


def totals_by_file(reports: DataFrame) -> DataFrame:
    """Totals per file name; a name found in no member has zeros."""
    session = reports.sparkSession
    names = session.createDataFrame([(name,) for name in _HEADERS], "csv string")
    totals = reports.groupBy("csv").agg(
        F.count_if("present").alias("files_present"),
        F.count_if("header_ok").alias("files_with_valid_header"),
        F.sum("rows_valid").alias("rows"),
        F.sum("rows_invalid").alias("invalid_rows"),
        F.sum("footer_rows_removed").alias("footer_rows_removed"),
    )
    return names.join(totals, "csv", "left").na.fill(0)


def problems(reports: DataFrame, notes: DataFrame) -> DataFrame:
    """Unreadable members and failed files with their messages."""
    state = F.col("estado")
    message = (
        F.when(state == "vacio", F.lit(EMPTY_MEMBER))
        .when(state == "corrupto", F.lit(CORRUPT_MEMBER))
        .otherwise(F.col("error"))
    )
    members = notes.where((F.col("tipo") == "miembro") & (state != "ok")).select(
        "zip", "archivo_origen", F.lit(None).cast("string").alias("archivo_csv"), message.alias("error")
    )
    files = reports.where(F.col("error").isNotNull()).select(
        "zip", "archivo_origen", F.col("csv").alias("archivo_csv"), "error"
    )
    return members.unionByName(files)
