"""The inspection job: reports of one or more archives, written as JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators import inspection
from gondola.sources.nested_zip import INSPECT, SCHEMA, read_archives
from gondola.sources.replacement import delete_folder


def inspect_archives(spark: SparkSession, archives: list[str], output: str) -> dict[str, DataFrame]:
    """Frames ``archivos`` (members per archive), ``reportes`` (per member and file), ``totales`` (per
    file name) and ``errores``, each also written as a JSON folder below ``output``, a folder that all
    executors reach.

    Every archive is unpacked once: its notes and rows are stored apart by kind, and all frames come from there.
    """
    scan = f"{output}/_lectura_{uuid.uuid4().hex}"
    try:
        read_archives(spark, archives, INSPECT).write.partitionBy("tipo").parquet(scan)
        stored = spark.read.schema(SCHEMA).parquet(scan)
        notes = stored.where(F.col("tipo") != "fila")
        made = {
            "reportes": inspection.file_reports(stored),
            "archivos": inspection.member_counts(notes).withColumn("inspected_at", F.current_timestamp()),
        }
        read = {name: _written(frame, f"{output}/{name}") for name, frame in made.items()}
        made = {"totales": inspection.totals_by_file(read["reportes"]), "errores": inspection.problems(read["reportes"], notes)}
        read |= {name: _written(frame, f"{output}/{name}") for name, frame in made.items()}
    finally:
        delete_folder(scan)
    return {name: read[name] for name in ("archivos", "reportes", "totales", "errores")}


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.mode("overwrite").json(path)
    return frame.sparkSession.read.schema(frame.schema).json(path)
