"""op12: what the driver holds does not grow with the queries, nor with the centroids times the sample."""

from __future__ import annotations

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from fogon.llm import op12_neighbours as op12


def test_centroids_are_trained_in_bounded_memory():
    sample = np.random.default_rng(3).standard_normal((4000, 8))
    sample /= np.sqrt((sample**2).sum(axis=1))[:, None]
    tracemalloc.start()
    centroids = op12.train(sample, 500)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert centroids.shape == (500, 8) and peak < 6 << 20  # all cosines at once are 16 MB
    number, near = op12._nearest_centroid(sample, centroids)
    every = sample @ centroids.T
    assert (number == every.argmax(axis=1)).all() and np.allclose(near, every.max(axis=1))


def test_batches_of_queries_are_not_broadcast(spark):
    none = F.lit(None)
    index = spark.range(2).select(F.col("id").alias("list"), *[none.cast("binary").alias(c) for c in ("ids", "least")], none.cast("array<binary>").alias("columns"))
    probes = spark.range(2).select(F.col("id").alias("query"), F.col("id").alias("list"), F.lit(1.0).alias("worst"), none.cast("binary").alias("y"))
    plan = op12._met(index, probes, 5)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1  # the latter for the number of queries of a list


def test_probes_of_many_queries_come_in_pieces():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    centroids, n = rng.standard_normal((20, 8)), 3 * op12.AT_ONCE + 7
    centroids /= np.sqrt((centroids**2).sum(axis=1))[:, None]
    vectors = [*rng.standard_normal((n - 1, 8)).tolist(), [1.0, 2.0]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(vectors, pa.list_(pa.float64())), pa.array([None] * n, pa.float64())], names=["query", "v", "worst"])
    sizes = {8: (np.ones(20), np.full(20, 0.9))}
    for first in (True, False):
        out = list(op12._probes(iter([batch]), {8: centroids}, sizes, first, 5))
        rows = [(q, x & op12.UNTRAINED) for b in out for q, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert max(len(b) for b in out) <= op12.AT_ONCE * 20
        near = {q: set(np.argsort(-(op12.rotated([np.array(vectors[q])]) @ centroids.T)[0], kind="stable")[: op12.FIRST].tolist()) for q in range(n - 1)}
        wanted = {q: s if first else set(range(20)) - s for q, s in near.items()}
        assert {q: {x for p, x in rows if p == q} for q in range(n - 1)} == wanted
        assert [x for q, x in rows if q == n - 1] == ([op12.UNTRAINED] if first else [])
