"""The usage cube shuffles a user's lines once and takes users of any size."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from fogon.operators import cubes


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lineas(spark):
    filas = [(u, p, f, p % 3, c, f"2024-01-{1 + (c % 28):02d}") for u in (1, 2, 3, None) for p in range(12) for f in ("mongo", "postgres")
             for c in range(1, 2 + (p * (u or 4)) % 4)]
    filas += [(2, 5, "mongo", 2, 1, None), (7, 999, "mongo", 1, 1, "2024-01-01")]
    return spark.createDataFrame(filas, "id_usuario LONG, id_producto LONG, fuente_datos STRING, categoria_id INT, cantidad INT, fecha_creacion STRING").withColumn(
        "subtotal", F.when(F.col("cantidad") != 2, F.col("cantidad")).cast("decimal(10,2)"))


def _dimensiones(spark):
    # Every second product has one name in both sources; one key is there twice.
    productos = [(p, f, f"n{p}" + (f if p % 2 else "")) for p in range(12) for f in ("mongo", "postgres")] + [(3, "mongo", "otro")]
    return (spark.createDataFrame(productos, "producto_id LONG, fuente_datos STRING, nombre STRING"),
            spark.createDataFrame([(0, "x"), (1, "y"), (2, "y")], "categoria_id INT, nombre_categoria STRING"))


def test_usage_cube_takes_any_user_either_way(spark):
    lineas, (productos, categorias) = _lineas(spark), _dimensiones(spark)
    for t, df in (("l", lineas), ("p", productos), ("c", categorias)):
        df.createOrReplaceTempView(f"uso_{t}")
    esperado = spark.sql("""
        select id_usuario, id_producto, nombre, nombre_categoria, count(*), sum(cantidad), cast(sum(subtotal) as double) / nullif(count(subtotal), 0),
         cast(sum(subtotal) as double), min(fecha_creacion), max(fecha_creacion), rank() over (partition by id_usuario order by count(*) desc)
        from uso_l join (select producto_id as id_producto, fuente_datos, nombre from uso_p) using (id_producto, fuente_datos) join uso_c using (categoria_id)
        group by id_usuario, id_producto, nombre, nombre_categoria""")
    esperado = sorted(map(tuple, esperado.collect()), key=str)
    assert any(f[0] is None for f in esperado)
    for limite in (0, 45, 10**6):  # all users by buckets, some, none
        assert sorted(map(tuple, cubes.cubo_frecuencia_uso(lineas, productos, categorias, limite).collect()), key=str) == esperado


def test_usage_cube_shuffles_plain_lines_by_user(spark):
    lineas, (productos, categorias) = _lineas(spark), _dimensiones(spark)
    demas = _plan(cubes.cubo_frecuencia_uso(lineas, productos, categorias)).split("Window", 1)[1].split("Exchange", 1)
    assert re.match(r" hashpartitioning\(id_usuario#\d+L, \d+\), REPARTITION_BY_COL", demas[1]) and "Aggregate" in demas[0]
