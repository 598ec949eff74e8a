"""Time the headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is written to the ``noop`` sink, so nothing is skipped for a small result: one warm-up run,
then the median of ``$BENCH_RUNS`` (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import CHECKS, Context  # noqa: E402

HEADLINE = [
    "mart_resumen_general",
    "mart_evolucion_productos",
    "mart_variacion_productos",
    "mart_resumen_productos",
    "mart_precios_por_comercio",
    "mart_precios_por_ubicacion",
    "mart_promociones",
    "mart_productos_mayor_dispersion",
    "mart_sucursales_geografia",
    "mart_calidad_precios",
    "mart_productos_comparables",
    "mart_precios_sospechosos",
    "mart_canasta_basica_candidatos",
    "a7_buscador_precios",
    "b3_precios_mas_altos",
    "b4_percentiles_altos",
    "b5_resumen_por_unidad",
    "b7_buscador_avanzado",
    "e2_mayores_aumentos",
    "d07_busqueda_productos",
    "d12_buscador_avanzado",
    "d14_canasta_por_categoria",
    "d21_candidatos",
    "k6_recursos_entre_fechas",
    "c9_limpieza_completa",
    "s1_s2_s3_lectura_de_archivos",
    "s7_s8_s11_construccion_de_marts",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gondola-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query: Callable[[], DataFrame]) -> float:
    """Time of making and running a query; some write tables while they are made."""
    start = time.perf_counter()
    frame = query()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in wanted:

        def query(run=CHECKS[name].run) -> DataFrame:
            return run(Context(spark, sf_dir))

        seconds(query)
        times[name] = round(statistics.median(seconds(query) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
