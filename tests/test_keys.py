"""Key tables of the facts: an increment reads its own buckets only, and a load that died is seen."""

import os

from pyspark.sql import functions as F

from fogon import schemas
from fogon.operators import dimensions as dims
from fogon.sources import keys
from fogon.sources.warehouse import Warehouse


def _pedidos(spark, desde: int, hasta: int):
    base = {c: F.lit(None).cast(t).alias(c) for c, t in schemas.TABLAS["fact_pedidos"].items()}
    propias = {"id_pedido": F.col("id"), "fuente_datos": F.when(F.col("id") % 3 == 0, "mongo").otherwise("postgres"), "anio": F.lit(2024), "mes": F.lit(1)}
    return spark.range(desde, hasta).select(*[propias[c].alias(c) if c in propias else e for c, e in base.items()])


def _bytes(carpetas):
    return sum(os.path.getsize(os.path.join(d, f)) for d in carpetas for f in os.listdir(d) if f.endswith(".parquet"))


def test_increment_reads_its_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "CLAVES_POR_CUBETA", 16)
    almacen = Warehouse(spark, f"{tmp_path}/w").init()
    almacen.append(_pedidos(spark, 0, 32_000), "fact_pedidos")
    almacen.append(_pedidos(spark, 32_000, 32_010), "fact_pedidos", 10)
    tabla = almacen.keys("fact_pedidos")
    assert tabla.read().count() == 32_010
    # The increment's ids are ints: keys are compared with the declared types.
    lote = almacen.stage(_pedidos(spark, 31_980, 32_030).withColumn("id_pedido", F.col("id_pedido").cast("int")), "lote")
    carpetas = tabla.folders(lote)
    assert _bytes(carpetas) < 0.05 * _bytes(tabla.folders())
    nuevas = dims.only_new_keys(lote, tabla, staged=True)
    leidos = {f for f in nuevas.inputFiles() if "_claves" in f}
    assert 0 < len(leidos) <= len(carpetas)
    assert "fact_pedidos/anio" not in nuevas._jdf.queryExecution().toString()
    assert sorted(r.id_pedido for r in nuevas.collect()) == list(range(32_010, 32_030))
    assert dims.only_new_keys(lote.filter("id_pedido < 32010"), tabla, staged=False).count() == 0


def test_key_of_a_load_that_died(spark, tmp_path):
    """Facts without their keys, or a warehouse that never had a key table: the keys are built from the facts."""
    almacen = Warehouse(spark, f"{tmp_path}/w").init()
    almacen.append(_pedidos(spark, 0, 50), "fact_pedidos")
    tabla = almacen.keys("fact_pedidos")
    try:
        with tabla.added(_pedidos(spark, 50, 60)):
            _pedidos(spark, 50, 60).write.mode("append").partitionBy("anio", "mes").parquet(almacen.path("fact_pedidos"))
            raise KeyboardInterrupt
    except KeyboardInterrupt:
        pass
    assert tabla.read().count() == 60
    lote = almacen.stage(_pedidos(spark, 40, 70), "lote")
    assert sorted(r.id_pedido for r in dims.only_new_keys(lote, tabla, staged=True).collect()) == list(range(60, 70))
    fs, ruta = tabla._fs(tabla.path)
    fs.delete(ruta, True)
    assert tabla.read(lote).count() >= 20 and tabla.read().count() == 60


def test_null_keys_and_empty_tables(spark, tmp_path):
    almacen = Warehouse(spark, f"{tmp_path}/w").init()
    lote = almacen.stage(_pedidos(spark, 0, 3).withColumn("id_pedido", F.when(F.col("id_pedido") > 0, F.col("id_pedido"))), "lote")
    tabla = almacen.keys("fact_pedidos")
    assert dims.only_new_keys(lote, tabla, staged=True).count() == 3 and tabla.read(lote).count() == 0
    almacen.append(lote, "fact_pedidos")
    assert dims.only_new_keys(lote, tabla, staged=True).count() == 0


def test_buckets_follow_the_load():
    assert [keys.buckets_for(n) for n in (0, 1, 100_000, 100_001, 10**6, 10**9, 10**12)] == [1, 1, 1, 2, 16, 16384, 65536]
