"""CSV export of report sections."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(secciones: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Write each section as CSV with a header into its own folder; returns name → folder."""
    carpetas = {nombre: f"{path.rstrip('/')}/{nombre}" for nombre in secciones}
    for nombre, df in secciones.items():
        df.write.mode("overwrite").option("header", "true").csv(carpetas[nombre])
    return carpetas
