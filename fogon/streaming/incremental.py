"""Incremental ETL: what has arrived since the last run is loaded by the same idempotent loads as a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fogon import schemas
from fogon.operators.extract import extract_detalle_doc, extract_pedidos_doc, extract_reservas_doc, union_sources
from fogon.operators.load import Extracted, run_etl
from fogon.sources.warehouse import Warehouse

FEEDS = {"pedidos": schemas.PEDIDO_DOC, "reservas": schemas.RESERVA_DOC}


def stream_feed(
    spark: SparkSession,
    kind: str,
    feed: str,
    almacen: Warehouse,
    dims: dict[str, DataFrame],
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load new files of a feed of JSON documents (``pedidos`` or ``reservas``), then stop.

    Meant to be started periodically; the checkpoint remembers the files already read. A batch replayed after a
    failure loads nothing twice, because rows whose natural key is in the warehouse are skipped. ``dims``
    has usuario, restaurante and producto.
    """
    lector = spark.readStream.schema(FEEDS[kind])
    if max_files is not None:
        lector = lector.option("maxFilesPerTrigger", str(max_files))

    def load(batch: DataFrame, _batch_id: int) -> None:
        def de(otro: str) -> DataFrame:
            # The other feed of the run is empty.
            return batch if kind == otro else batch.sparkSession.createDataFrame([], FEEDS[otro])

        pedidos, reservas = de("pedidos"), de("reservas")
        extraido = Extracted(
            pedidos=union_sources(mongo=extract_pedidos_doc(pedidos, dims["usuario"], dims["restaurante"])),
            reservas=union_sources(mongo=extract_reservas_doc(reservas)),
            detalle=union_sources(
                mongo=extract_detalle_doc(pedidos, dims["producto"], dims["usuario"], dims["restaurante"])
            ),
        )
        run_etl(extraido, almacen, incremental=True)

    return (
        lector.json(feed).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
