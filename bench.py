"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores
(default all). The warehouse load and the graph tables are timed as queries of their own; every other query
reads the written tables. Each result is computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fogon.plans.context import context  # noqa: E402
from fogon.plans.queries import queries  # noqa: E402
from fogon.session import local_session  # noqa: E402

TITULARES = [
    "E01", "E06", "E20", "C01", "C03", "C04", "C06", "C07", "C08", "C09", "A04", "A09", "A10", "A12", "D05", "D10", "D14", "D18",
    "D21", "D25", "D28", "G12", "G15", "G17", "G18", "G20", "G22", "G26", "G36", "G44", "T02", "O01",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), 8)
    ctx = context(spark, sf_dir)
    tiempos: dict[str, float] = {}

    def medir(nombre: str, fn) -> None:
        inicio = time.perf_counter()
        fn()
        tiempos[nombre] = round(time.perf_counter() - inicio, 3)

    medir("E21_carga", lambda: ctx.almacen)
    medir("G11_comprado_con", lambda: ctx.comprado_con)
    medir("G14_distancias", lambda: ctx.distancias)
    consultas = queries()
    for nombre in TITULARES:
        medir(nombre, lambda: consultas[nombre](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(tiempos.values()), 3), "unit": "sec", "queries": tiempos,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    ctx.drop()
    spark.stop()


if __name__ == "__main__":
    main()
