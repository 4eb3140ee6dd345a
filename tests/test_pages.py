"""Pages of written listings against plain sorting."""

import random

from pyspark.sql import functions as F

from fogon.operators.pages import Listing

AZAR = random.Random(3)
FILAS = [(i, AZAR.choice(["a", "b", "b", "b", None]), AZAR.choice([None, 1.5, *range(20)]) if i % 3 else 7.0, "x" * (i % 5)) for i in range(3000)]


def listing(spark, tmp_path, filas, orden, grupo=None, ranges=9):
    df = spark.createDataFrame([(i, g, None if p is None else float(p), t) for i, g, p, t in filas], "id long, g string, puntos double, texto string")
    return Listing(spark, f"{tmp_path}/l", orden, grupo).write(df, ranges)


def test_pages_across_ranges(spark, tmp_path):
    """A third of the rows share one value; nulls sort as Spark sorts them (last in descending order)."""
    lista = listing(spark, tmp_path, FILAS, [F.desc("puntos"), "id"])
    orden = [f[0] for f in sorted(FILAS, key=lambda f: (f[2] is None, -(f[2] or 0), f[0]))]
    for pagina, n in ((1, 10), (34, 10), (7, 400), (8, 400), (300, 10), (301, 10)):
        hallado = lista.page(pagina, n).collect()
        assert [r.id for r in hallado] == orden[(pagina - 1) * n : pagina * n]
        assert {r.total for r in hallado} <= {3000}


def test_pages_of_a_group(spark, tmp_path):
    lista = listing(spark, tmp_path, FILAS, ["id"], "g")
    for g in ("a", "b", None, "zz"):
        ids = [f[0] for f in FILAS if f[1] == g]
        for pagina in (1, 2, 20):
            hallado = lista.page(pagina, 50, g).collect()
            assert [r.id for r in hallado] == ids[(pagina - 1) * 50 : pagina * 50]
            assert {r.total for r in hallado} <= {len(ids)}


def test_empty_listing(spark, tmp_path):
    lista = listing(spark, tmp_path, [], ["id"], ranges=None)
    assert lista.page().collect() == []
    assert lista.page().columns == ["id", "g", "puntos", "texto", "total"]


def test_a_deep_page_reads_its_ranges_only(spark, tmp_path):
    lista = Listing(spark, f"{tmp_path}/l", ["id"]).write(spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("id")), 40)
    assert 1 <= len(lista.tocados(1000, 10)) <= 2
    pagina = lista.page(1000, 10)
    assert [r.id for r in pagina.collect()] == sorted(i * 7919 % 100_003 for i in range(100_000))[9990:10_000]
    # Only the folders of these ranges are read.
    assert pagina.select(F.input_file_name()).columns and "rango" in pagina._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
