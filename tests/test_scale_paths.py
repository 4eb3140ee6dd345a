"""The ways taken for large or skewed groups give the same results as plain brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fogon.functions import knn, ordered, sizing
from fogon.functions.knn import k_nearest
from fogon.functions.pairs import pairs_within
from fogon.operators import cubes, dashboard, report
from fogon.operators.graph.copurchase import copurchase
from fogon.operators.graph import delivery, routing
from fogon.operators.graph.routing import routes, unroutable
from fogon.operators.search import edits
from fogon.session import size_shuffles

RNG = np.random.default_rng(7)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_pairs_of_a_hot_group(spark):
    """One group holds most rows; every pair comes exactly once whatever the block size."""
    datos = [(1, int(m)) for m in range(150)] + [(g, m) for g in range(2, 12) for m in range(5)] + [(99, 1)]
    df = spark.createDataFrame(datos, "g bigint, m bigint")
    esperado = df.alias("a").join(df.alias("b"), (F.col("a.g") == F.col("b.g")) & (F.col("a.m") < F.col("b.m"))).select("a.g", "a.m", "b.m")
    for bloque in (4, 32, 1000):
        assert rows(pairs_within(df, ["g"], "m", bloque).select("g", "m1", "m2")) == rows(esperado)


def test_pairs_key_stays_small(spark):
    df = spark.range(3000).select(F.lit(1).alias("g"), F.col("id").alias("m"))
    pares = pairs_within(df, ["g"], "m", 100)
    assert pares.count() == 3000 * 2999 // 2


def test_copurchase_with_a_hot_order(ctx, spark):
    contiene = ctx.contiene.unionByName(
        ctx.nodos["Producto"].filter("source_db = 'mongo'").select(F.lit(-1).cast("bigint").alias("id_pedido"), "id_producto", "source_db", F.lit(1).alias("cantidad"))
    )
    assert rows(copurchase(contiene, ctx.nodos["Pedido"], 16)) == rows(copurchase(contiene, ctx.nodos["Pedido"], 10**6))


def _brute_nearest(puntos, destinos, k):
    def v(lat, lng):
        a, o = np.radians(lat), np.radians(lng)
        return np.stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)], axis=-1)

    d = np.arccos(np.clip(v(puntos["lat"], puntos["lng"]) @ v(destinos["dlat"], destinos["dlng"]).T, -1, 1)) * 6371
    d = np.round(d, 3)
    salida = set()
    for i, p in enumerate(puntos["id"]):
        orden = sorted(range(len(destinos)), key=lambda j: (d[i, j], destinos["did"].iloc[j]))[:k]
        salida |= {(int(p), puesto + 1, d[i, j]) for puesto, j in enumerate(orden)}
    return salida


@pytest.mark.parametrize("k", [1, 5])
def test_nearest_matches_brute_force(spark, k):
    """Whole globe, poles and date line, a dense town, and a third of all targets on one spot."""
    lat = np.concatenate([RNG.uniform(-90, 90, 120), RNG.normal(9.9, 0.01, 120), [89.99, -89.99, 0.0, 0.0], np.full(120, 9.93)])
    lng = np.concatenate([RNG.uniform(-180, 180, 120), RNG.normal(-84.1, 0.01, 120), [10.0, -170.0, 179.999, -179.999], np.full(120, -84.08)])
    destinos = pd.DataFrame({"did": np.arange(len(lat)), "dlat": lat, "dlng": lng, "g": "x"})
    plat = np.concatenate([RNG.uniform(-90, 90, 60), RNG.normal(9.9, 0.02, 60), [90.0, 0.0, 9.93]])
    plng = np.concatenate([RNG.uniform(-180, 180, 60), RNG.normal(-84.1, 0.02, 60), [0.0, -180.0, -84.08]])
    puntos = pd.DataFrame({"id": np.arange(len(plat)), "lat": plat, "lng": plng, "g": "x"})
    df = k_nearest(spark.createDataFrame(puntos), spark.createDataFrame(destinos), k, ("lat", "lng"), ("dlat", "dlng"), "did", ["g"])
    hallado = {(r.id, r.puesto, round(r.distancia_km, 3)) for r in df.collect()}
    esperado = _brute_nearest(puntos, destinos, k)
    assert len(hallado) == len(esperado)
    por_puesto = {(i, p): d for i, p, d in esperado}
    assert max(abs(por_puesto[(i, p)] - d) for i, p, d in hallado) < 0.002


def test_nearest_rows_are_bounded(spark):
    """Rows per target and per point do not depend on how many there are, nor on how crowded a place is."""
    lat = np.concatenate([RNG.uniform(8, 11, 3000), RNG.normal(9.93, 0.0005, 3000)])
    lng = np.concatenate([RNG.uniform(-86, -83, 3000), RNG.normal(-84.08, 0.0005, 3000)])
    sitios = spark.createDataFrame(pd.DataFrame({"g": "x", "_lat": lat, "_lng": lng})).withColumns(knn._axes())
    llenas = knn.tree(sitios, ["g"], 5)
    assert llenas.count() <= 13 * 6000 // 5 + 8
    assert llenas.groupBy("nivel").count().filter("nivel = 0").first()["count"] == 1
    en_bolas = knn.search_cells(sitios.withColumns({"nivel": F.lit(8), "_r": F.pow(F.lit(10.0), -1 - F.rand(5) * 7)}))
    por_sitio = en_bolas.groupBy("_lat", "_lng").agg(F.count(F.lit(1)).alias("n"), F.max("nivel").alias("m")).agg(F.max("n"), F.min("n")).first()
    assert 1 <= por_sitio[1] and por_sitio[0] <= 8


def test_nearest_with_few_targets_and_other_groups(spark):
    puntos = spark.createDataFrame([(1, 9.9, -84.0, "x"), (2, 9.9, -84.0, "y"), (3, None, 1.0, "x"), (4, 1.0, 1.0, "z")], "id int, lat double, lng double, g string")
    destinos = spark.createDataFrame([(7, -40.0, 100.0, "x"), (8, 9.9, -84.0, "y"), (9, 9.9, None, "y")], "did int, dlat double, dlng double, g string")
    df = k_nearest(puntos, destinos, 3, ("lat", "lng"), ("dlat", "dlng"), "did", ["g"])
    assert sorted((r.id, r.did) for r in df.collect()) == [(1, 7), (2, 8)]


def test_nearest_stops_of_a_driver(spark):
    """Spots shared by many stops, drivers with one stop, stops without a place; all pairs as the measure."""
    azar = random.Random(8)
    filas = [("postgres", 1, i, 9.9 + azar.randrange(6) / 50, -84 + azar.randrange(6) / 50) for i in range(90)]
    filas += [("mongo", 1, 3, 9.9, -84.0), ("postgres", 2, 5, 9.9, -84.0), ("postgres", 2, 6, 9.8, -84.0), ("postgres", 1, 900, None, -84.0)]
    paradas = spark.createDataFrame(filas, "source_db string, id_repartidor long, id_usuario long, latitud double, longitud double")
    todas = delivery.stop_matrix(paradas).filter("distancia_km is not null")
    por = {}
    for r in todas.collect():
        por.setdefault((r.source_db, r.id_repartidor, r.desde), []).append((r.distancia_km, r.hasta))
    esperado = sorted((*k, i + 1, round(d, 9)) for k, v in por.items() for i, (d, _) in enumerate(sorted(v)[:4]))
    cercanas = delivery.nearest_stops(paradas, 4).collect()
    assert sorted((r.source_db, r.id_repartidor, r.desde, r.puesto, round(r.distancia_km, 9)) for r in cercanas) == esperado
    assert all(r.desde != r.hasta for r in cercanas)


def _greedy(paradas: pd.DataFrame):
    lat, lng = paradas["latitud_actual"].iloc[0], paradas["longitud_actual"].iloc[0]
    quedan, orden = list(paradas.sort_values("id_usuario").itertuples()), []
    def d(p):
        a, b = np.radians(lat), np.radians(p.latitud)
        c = np.cos(a) * np.cos(b) * np.cos(np.radians(p.longitud - lng)) + np.sin(a) * np.sin(b)
        return 6371 * np.arccos(min(1.0, c))
    while quedan:
        p = min(quedan, key=lambda p: (d(p), p.id_usuario))
        quedan.remove(p)
        orden.append(p.id_usuario)
        lat, lng = p.latitud, p.longitud
    return orden


def test_routes_of_any_length(spark):
    """The order equals that of plain greedy steps, also with more than 1,000 stops; no position means no route."""
    filas = []
    for conductor, n in ((1, 1100), (2, 9), (3, 60)):
        for u in range(n):
            filas.append(("pg", conductor, u, f"u{u}", float(RNG.normal(9.9, 0.2)), float(RNG.normal(-84, 0.2)), 9.9, -84.0))
    columnas = ["source_db", "id_repartidor", "id_usuario", "nombre", "latitud", "longitud", "latitud_actual", "longitud_actual"]
    pdf = pd.DataFrame(filas, columns=columnas)
    sin_lugar = spark.createDataFrame([("pg", 9, 1, "x", 9.0, -84.0, None, None)], spark.createDataFrame(pdf).schema)
    df = spark.createDataFrame(pdf).unionByName(sin_lugar)
    orden = routes(df).orderBy("id_repartidor", "orden").toPandas()
    assert set(orden["id_repartidor"]) == {1, 2, 3}
    for conductor, grupo in pdf.groupby("id_repartidor"):
        assert list(orden[orden["id_repartidor"] == conductor]["id_usuario"]) == _greedy(grupo)
    assert rows(unroutable(df)) == [("pg", 9, 1, "Repartidor sin ubicación")]


def test_routes_hold_a_pool_at_a_time(spark, monkeypatch):
    """No task gets more stops of a driver than the pool, and the route is the greedy one; stops without a position come last."""
    filas = [("pg", c, u, f"u{u}", float(RNG.normal(9.9, 0.2)), float(RNG.normal(-84, 0.2)), 9.9, -84.0) for c, n in ((1, 60), (2, 12), (3, 5)) for u in range(n)]
    columnas = ["source_db", "id_repartidor", "id_usuario", "nombre", "latitud", "longitud", "latitud_actual", "longitud_actual"]
    pdf = pd.DataFrame(filas, columns=columnas)
    df = spark.createDataFrame(pdf)
    perdidas = spark.createDataFrame([("pg", 3, u, "x", None, None, 9.9, -84.0) for u in (101, 100)], df.schema)

    with monkeypatch.context() as m:
        original = routing._walk
        m.setattr(routing, "_walk", lambda pool: original(pool) if pool.num_rows <= 20 else 1 / 0)
        orden = routes(df.unionByName(perdidas), pool=20).orderBy("id_repartidor", "orden").toPandas()
    for conductor, grupo in pdf.groupby("id_repartidor"):
        esperado = _greedy(grupo) + ([100, 101] if conductor == 3 else [])
        assert list(orden[orden["id_repartidor"] == conductor]["id_usuario"]) == esperado
    assert set(orden.groupby("id_repartidor")["total_paradas"].first()) == {60, 12, 7}


def test_routes_of_one_very_long_driver(spark):
    """One driver holds nearly all stops, thousands of them at one spot, some without an id or a place: each is visited once, greedily."""
    n = 700
    lat, lng = RNG.normal(9.9, 0.2, n), RNG.normal(-84, 0.2, n)
    lat[:250], lng[:250] = 9.95, -84.05
    filas = [("pg", 1, u, "u", float(lat[u]), float(lng[u]), 9.9, -84.0) for u in range(n)]
    filas += [("pg", 1, None, "u", 9.95, -84.05, 9.9, -84.0)] * 2 + [("pg", 1, u, "u", None, None, 9.9, -84.0) for u in (n + 2, n + 1)]
    filas += [("pg", None, 5, "u", 9.0, -84.0, 9.9, -84.0), (None, 4, 5, "u", 9.0, -84.0, 9.9, -84.0), ("pg", 2, 7, "u", 9.0, -84.0, 9.9, -84.0)]
    tipos = "source_db string, id_repartidor long, id_usuario long, nombre string, latitud double, longitud double, latitud_actual double, longitud_actual double"
    df = spark.createDataFrame(filas, tipos)
    orden = routes(df, pool=200).orderBy("id_repartidor", "orden").toPandas()
    uno = orden[orden["id_repartidor"] == 1]
    assert list(uno["orden"]) == list(range(1, n + 5)) and set(uno["total_paradas"]) == {n + 4}
    plano = pd.DataFrame(filas[: n + 2], columns=df.columns)
    plano["id_usuario"] = plano["id_usuario"].fillna(10**9)
    esperado = [None if u == 10**9 else u for u in _greedy(plano)] + [n + 1, n + 2]
    assert [None if pd.isna(u) else int(u) for u in uno["id_usuario"]] == esperado
    assert uno["distancia_acumulada"].dropna().is_monotonic_increasing and uno["distancia_tramo"].isna().sum() == 2
    assert rows(unroutable(df)) == [("pg", None, 1, "Repartidor sin identificador"), (None, 4, 1, "Repartidor sin identificador")]


def test_ranks_and_medians_with_ties(spark):
    n = 4000
    v = np.where(RNG.random(n) < 0.34, 100.0, np.round(RNG.normal(0, 500, n), 2))
    df = spark.createDataFrame(pd.DataFrame({"g": RNG.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]), "v": v, "i": np.arange(n)}))
    esperado = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).cast("bigint"))
    assert rows(ordered.rank_desc(df, ["g"], "v", "r").select("g", "v", "i", "r")) == rows(esperado.select("g", "v", "i", "r"))
    medianas = df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).select("g", "m")
    assert rows(ordered.median(df, ["g"], "v", "m")) == rows(medianas)
    nombres = spark.createDataFrame([(x,) for x in ("ñandú", "b", "", "aa", "ab", "a", "Z", "é")], "s string")
    numerados = dict(map(tuple, ordered.row_numbers(nombres, "s", "n").collect()))
    assert [s for s, _ in sorted(numerados.items(), key=lambda x: x[1])] == ["", "Z", "a", "aa", "ab", "b", "é", "ñandú"]
    assert sorted(numerados.values()) == list(range(1, 9))


def test_shuffle_partitions_follow_the_input(spark):
    clave = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffles(spark, 10**6) == 4 and spark.conf.get(clave, None) is None
        assert size_shuffles(spark, 10**12) == 14902 and spark.conf.get(clave) == "14902"
        assert size_shuffles(spark, 2 * 10**12) == 29803 and spark.conf.get(clave) == "29803"
    finally:
        spark.conf.unset(clave)
        spark.conf.unset("spark.fogon.initialPartitionNum")


def test_size_check_reads_file_sizes(ctx):
    assert 0 < sizing.plan_bytes(ctx.tiempo) < 10**6


def test_time_cubes_shuffle_facts_once(ctx, spark):
    """No join by minute: with broadcast off, the only shuffles are those of the aggregation."""
    umbral = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for nombre in ("cubo_pedidos_ubicacion", "cubo_actividad_zona"):
            plan = ctx.cubo(nombre)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "hashpartitioning(tiempo_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", umbral)


def test_swapped_letters_are_one_edit(spark):
    pares = [("sopa", "spoa", 1), ("sopa", "sopa", 0), ("abcd", "badc", 2), ("abcd", "acbe", 2), ("ab", "", 2), ("abcdef", "fedcba", 3)]
    df = spark.createDataFrame(pares, "t string, p string, e int")
    assert all(r.e == r.x for r in df.select("e", edits(F.col("t"), F.col("p")).alias("x")).collect())


def test_year_filter_on_a_cube_prunes_fact_partitions(ctx):
    cubo = cubes.cubo_pedidos_ubicacion(ctx.pedidos, ctx.tiempo).filter("anio = 1997 and mes = 3")
    plan = cubo._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and "= 1997" in plan


def test_rollup_without_broadcast_is_the_same(ctx, spark):
    """With a time dimension too large to broadcast, facts are summed per minute before the join."""
    consultas = {
        "C01": lambda: cubes.cubo_pedidos_tiempo(ctx.tiempo, ctx.pedidos),
        "C04": lambda: cubes.cubo_actividad_zona(ctx.pedidos, ctx.tiempo),
        "C06": lambda: cubes.cubo_productos_tiempo(ctx.tiempo, ctx.detalle, ctx.categorias),
        "C09": lambda: cubes.cubo_frecuencia_uso(ctx.detalle, ctx.productos, ctx.categorias),
        "A06": lambda: report.finde_vs_laboral(ctx.pedidos, ctx.tiempo),
    }
    directo = {n: rows(q()) for n, q in consultas.items()}
    antes = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert {n: rows(q()) for n, q in consultas.items()} == directo
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", antes)
