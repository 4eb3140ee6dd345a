"""Approximate nearest neighbours by cosine: inverted lists, scanned dimension block by dimension block.

1. Vectors are scaled to length one and rotated at random, so that the first dimensions of a difference say, within known
   limits, how long all of it is. Equal vectors are one node.
2. Centroids are trained on a bounded sample; every node belongs to the list of its nearest one. A list is stored in blocks
   of about a thousand nodes, and a block in column blocks of 16 rotated dimensions.
3. A query scans its nearest lists first. What it has found there says which other lists are worth it: a list's size and mean
   cosine give the number of better nodes to expect in it, and lists are left out only as long as all of those left out make less
   than a quarter of a node.
4. Within a block, partial squared distances grow column block by column block. A candidate is abandoned as soon as the hypothesis
   that it is nearer than the query's limit is rejected: its partial distance, scaled up to all dimensions, lies beyond the limit by more
   than the test allows at that number of dimensions.
5. The nearest nodes of each block meet per query, and the cosine of the original vectors decides their order.

Lists and queries meet in a join of packed rows, a block with a batch of queries, so neither a list nor its queries have to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erfc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fogon.functions.sizing import never_broadcast
from fogon.llm.store import cut, prepare
from fogon.llm.words import release, tidy

K = 5
EVERY = 50  # a query for every so many ids
SAMPLE = 20_000  # vectors that centroids are trained on, at most
SAMPLE_VALUES = 4_000_000  # and numbers in them
ROUNDS = 8
WIDTH = 16  # dimensions of a column block
BLOCK, BATCH = 1024, 256  # nodes of a block, queries of a batch
AT_ONCE = 256  # vectors that are compared with all centroids at a time
FIRST = 8  # lists that are scanned before the others are chosen
MISSED = 0.25  # better nodes to expect in all lists that are left out
EPSILON = 2.1  # of the test: a nearer candidate is abandoned with a probability of about exp(-EPSILON ** 2 / 2) per test at most
SEED = 20_250_911
UNTRAINED = 0xFFFFFFFF  # list of vectors of a dimension that the sample doesn't hold
VECTORS = "node long, list long, near double, least long, y binary"
PACKED = "list long, ids binary, least binary, columns array<binary>"


def rotation(dimension: int) -> np.ndarray:
    """A random orthonormal matrix, the same one everywhere."""
    q, _ = np.linalg.qr(np.random.Generator(np.random.PCG64([SEED, dimension])).standard_normal((dimension, dimension)))
    return q


def rotated(rows: list[np.ndarray]) -> np.ndarray:
    """Unit vectors of one dimension after the rotation."""
    x = np.stack(rows).astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    return x @ rotation(x.shape[1]).T


def _cosines(y: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Cosines with all centroids, for some rows at a time: there are as many centroids as the root of the vectors, so all rows at once would grow with them."""
    for i in range(0, len(y), AT_ONCE):
        rows = slice(i, i + AT_ONCE)
        yield rows, y[rows] @ centroids.T


def _nearest_centroid(y: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, and the cosine with it."""
    number, near = np.zeros(len(y), dtype=np.int64), np.zeros(len(y))
    for rows, cosine in _cosines(y, centroids):
        number[rows], near[rows] = cosine.argmax(axis=1), cosine.max(axis=1)
    return number, near


def train(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of length one: a few rounds of spherical k-means, begun with rows of the sample."""
    centroids = sample[np.random.Generator(np.random.PCG64(SEED)).permutation(len(sample))[:lists]].copy()
    for _ in range(ROUNDS):
        own, _ = _nearest_centroid(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        length = np.sqrt((sums * sums).sum(axis=1))
        centroids[length > 0] = sums[length > 0] / length[length > 0, None]
    return centroids


def _by_dimension(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, rows and rotated vectors of each dimension of a column."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.diff(vectors.offsets.to_numpy()))
    lengths = np.diff(np.r_[0, ends])
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, rotated([flat[ends[i] - d : ends[i]] for i in rows])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """node, least, v -> VECTORS."""
    for batch in batches:
        node, least = (batch.column(i).to_numpy() for i in (0, 1))
        for d, rows, y in _by_dimension(batch.column(2)):
            number, near = np.full(len(rows), UNTRAINED), np.zeros(len(rows))
            if d in centroids:
                number, near = _nearest_centroid(y, centroids[d])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[rows]), pa.array((d << 32) | number.astype(np.int64)), pa.array(near), pa.array(least[rows]), pa.array([r.tobytes() for r in y], pa.binary())],
                names=["node", "list", "near", "least", "y"])


def _packed(rows: pa.Table) -> pa.Table:
    """One block of a list: nodes, their smallest ids, and the vectors by column blocks."""
    y = np.stack([np.frombuffer(v, dtype=np.float64) for v in rows.column("y").to_pylist()])
    columns = [np.ascontiguousarray(y[:, i : i + WIDTH]).tobytes() for i in range(0, y.shape[1], WIDTH)]
    out = pa.table({
        "list": pa.array([rows.column("list")[0].as_py()], pa.int64()), "ids": pa.array([rows.column("node").to_numpy().tobytes()], pa.binary()),
        "least": pa.array([rows.column("least").to_numpy().tobytes()], pa.binary()), "columns": pa.array([columns], pa.list_(pa.binary()))})
    release()
    return out


def worthwhile(cosine: np.ndarray, size: np.ndarray, mean: np.ndarray, limit: float, dimension: int) -> np.ndarray:
    """Which lists to scan: those left out hold, in sum, less than MISSED better nodes in expectation.

    cosine is the query's with each centroid, mean that of a list's nodes, limit the cosine to beat. What is left of query and node beside the
    centroid is taken as randomly directed.
    """
    spread = np.sqrt(np.maximum((1 - mean**2) * (1 - cosine**2), 1e-12) / max(dimension - 1, 1))
    expected = size * 0.5 * np.array([erfc(z) for z in ((limit - mean * cosine) / (spread * np.sqrt(2))).tolist()])
    order = np.argsort(expected)
    out = np.zeros(len(size), dtype=bool)
    out[order[np.cumsum(expected[order]) > MISSED]] = True
    return out & (size > 0)


def _probes(batches: Iterator[pa.RecordBatch], centroids: dict[int, np.ndarray], lists: dict[int, tuple[np.ndarray, np.ndarray]], first: bool, k: int) -> Iterator[pa.RecordBatch]:
    """query, v, worst -> query, list, worst, y: a row for each list that is scanned now. worst is a squared distance, null if there are too few."""
    for batch in batches:
        query, worst = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
        for d, rows, y in _by_dimension(batch.column(1)):
            if d not in centroids:
                own = rows if first else rows[:0]
                yield _probed(query[own], np.full(len(own), (d << 32) | UNTRAINED), worst[own], y[: len(own)])
                continue
            size, mean = lists[d]
            for some, cosine in _cosines(y, centroids[d]):
                cosine = np.clip(cosine, -1, 1)
                order = np.argsort(-np.where(size > 0, cosine, -9), axis=1, kind="stable")
                chosen: list[np.ndarray] = []
                for i, limit in enumerate(worst[rows[some]]):
                    near = order[i, :FIRST]
                    if not first:
                        rest = worthwhile(cosine[i], size, mean, 1 - limit / 2, d) if np.isfinite(limit) else size > 0
                        rest[near] = False
                        near = np.flatnonzero(rest)
                    chosen.append(near)
                at = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
                numbers = np.concatenate([np.zeros(0, dtype=np.int64), *chosen]).astype(np.int64)
                own = rows[some][at]
                yield _probed(query[own], (d << 32) | numbers, worst[own], y[some][at])


def _probed(query: np.ndarray, lists: np.ndarray, worst: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(query), pa.array(lists), pa.array(np.where(np.isfinite(worst), worst, np.inf)), pa.array([v.tobytes() for v in y], pa.binary())],
        names=["query", "list", "worst", "y"])


def _batched(rows: pa.Table) -> pa.Table:
    out = pa.table({
        "list": pa.array([rows.column("list")[0].as_py()], pa.int64()), "queries": pa.array([rows.column("query").to_numpy().tobytes()], pa.binary()),
        "worst": pa.array([rows.column("worst").to_numpy().tobytes()], pa.binary()), "ys": pa.array([b"".join(rows.column("y").to_pylist())], pa.binary())})
    release()
    return out


def scan(columns: list[np.ndarray], least: np.ndarray, queries: np.ndarray, worst: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, node row, squared distance) of the k nearest of a block for each query, and the number of dimensions read.

    worst is the squared distance that a query has to beat. Of equal distances (to 12 digits) the smaller ``least`` wins.
    """
    d, n = queries.shape[1], len(least)
    part = queries[:, :WIDTH]
    partial = (part**2).sum(axis=1)[:, None] + (columns[0] ** 2).sum(axis=1)[None, :] - 2 * part @ columns[0].T
    read = partial.size * columns[0].shape[1]
    # The nearest so far are measured in full: the worst of them is a limit too.
    some = np.argpartition(partial, k - 1, axis=1)[:, :k] if n > k else np.tile(np.arange(n), (len(queries), 1))
    full = np.zeros(some.shape)
    for j, c in enumerate(columns):
        full += ((c[some] - queries[:, None, WIDTH * j : WIDTH * j + c.shape[1]]) ** 2).sum(axis=2)
    limit = np.minimum(worst, full.max(axis=1)) if n >= k else worst
    limit = limit + 1e-9

    def tested(distance: np.ndarray, dims: int, bound: np.ndarray) -> np.ndarray:
        slack = (1 + EPSILON / np.sqrt(dims)) ** 2 if dims < d else 1.0
        return distance <= bound * (dims / d) * slack

    r, c = np.nonzero(tested(partial, columns[0].shape[1], limit[:, None]))
    found = np.maximum(partial[r, c], 0)
    dims = columns[0].shape[1]
    for j, column in enumerate(columns[1:], 1):
        found = found + ((column[c] - queries[r, WIDTH * j : WIDTH * j + column.shape[1]]) ** 2).sum(axis=1)
        read += len(r) * column.shape[1]
        dims += column.shape[1]
        keep = tested(found, dims, limit[r])
        r, c, found = r[keep], c[keep], found[keep]
    order = np.lexsort((least[c], np.round(found, 12), r))
    r, c, found = r[order], c[order], found[order]
    begin = np.searchsorted(r, r, side="left")
    top = np.arange(len(r)) - begin < k
    return r[top], c[top], found[top], read


def _scanned(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A block with a batch of queries in each row -> (query, node, least, distance)."""
    for batch in batches:
        for row in batch.to_pylist():
            nodes, least, queries, worst = (np.frombuffer(row[x], dtype=t) for x, t in (("ids", np.int64), ("least", np.int64), ("queries", np.int64), ("worst", np.float64)))
            columns = [np.frombuffer(x, dtype=np.float64).reshape(len(nodes), -1) for x in row["columns"]]
            r, c, distance, _ = scan(columns, least, np.frombuffer(row["ys"], dtype=np.float64).reshape(len(queries), -1), worst, k)
            yield pa.RecordBatch.from_arrays([pa.array(queries[r]), pa.array(nodes[c]), pa.array(least[c]), pa.array(distance)], names=["query", "node", "least", "distance"])


def _met(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """The k nearest nodes of every query within the blocks of its lists.

    A query stands in most of the lists, so its batches are many times what Spark takes them for by the size of the queries.
    """
    held = probes.groupBy("list").agg(F.ceil(F.count("*") / BATCH).cast("long").alias("batches"))
    # One row per centroid at most.
    dealt = probes.join(F.broadcast(held), "list").withColumn("batch", F.pmod(F.xxhash64("query", F.lit(3)), F.col("batches")))
    batches = dealt.select("list", "batch", "query", "worst", "y").repartition("list", "batch").groupBy("list", "batch").applyInArrow(_batched, "list long, queries binary, worst binary, ys binary")
    pairs = index.join(never_broadcast(batches), "list").select("ids", "least", "columns", "queries", "worst", "ys")
    found = pairs.mapInArrow(lambda it: tidy(_scanned(it, k)), "query long, node long, least long, distance double")
    return _nearest(found, k)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.round("distance", 12), "least", "node")
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).drop("place")


def _usable(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False)))


def _cosine(a: F.Column, b: F.Column) -> F.Column:
    """In double precision, scaled first so that no square overflows."""
    def scaled(x: F.Column) -> F.Column:
        return F.transform(F.array(F.array_max(F.transform(x, F.abs))), lambda m: F.transform(x, lambda v: v / m))[0]

    def dot(x: F.Column, y: F.Column) -> F.Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    x = F.transform(F.array(F.struct(scaled(a).alias("a"), scaled(b).alias("b"))), lambda s: dot(s["a"], s["b"]) / (F.sqrt(dot(s["a"], s["a"])) * F.sqrt(dot(s["b"], s["b"]))))[0]
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``vectors`` to each row of ``queries``, both (vec_id, embedding).

    ``queries`` are rows of ``vectors``; a row is no candidate of its own, but copies and other rows of its vec_id are. Rows that are null,
    empty or zero, or hold null or non-finite components, or have no vec_id, take no part. Vectors of another dimension are no candidates. A query has
    fewer than k rows only if there are fewer candidates. Equal scores are ordered by vec_id. Other columns are ignored.
    """
    spark = prepare(vectors.sparkSession)
    same = ["h1", "h2", "v"]
    first = Window.partitionBy(*same).orderBy("vec_id")
    # k + 1 rows of a class of equal vectors are enough for any query; they are chosen before the class meets in one task.
    few = _usable(vectors).withColumns({"h1": F.xxhash64("v"), "h2": F.hash("v")}).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    classes = few.groupBy(*same).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("node"), "ids", "v"), "ann-classes")
    asked = cut(_usable(queries).select(F.monotonically_increasing_id().alias("query"), "vec_id", "v"), "ann-queries")

    n, widest = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    rows = min(SAMPLE, SAMPLE_VALUES // (widest or 1))
    sample = classes.select(F.col("v").cast("array<float>").alias("v"), F.xxhash64("v").alias("h")).orderBy("h").limit(max(rows, 1)).toArrow()
    lists = int(np.ceil(np.sqrt(n)))
    centroids: dict[int, np.ndarray] = {}
    for d, own, y in _by_dimension(sample.column("v").combine_chunks()) if len(sample) else ():
        fine = np.isfinite(y).all(axis=1)
        if fine.any():
            share = max(1, min(lists * len(own) // len(sample), len(own) // 8))
            centroids[d] = train(y[fine], share)

    table = cut(classes.select("node", F.col("ids")[0].alias("least"), "v").mapInArrow(lambda it: tidy(_assigned(it, centroids)), VECTORS), "ann-vectors")
    about = table.groupBy("list").agg(F.count("*").alias("n"), F.avg("near").alias("near"))
    blocks = table.join(about.select("list", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")), "list")
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks"))).select("list", "block", "node", "least", "y")
    # Dealt by both: a join by list alone would leave all blocks of a list with one task.
    index = cut(blocks.repartition("list", "block").groupBy("list", "block").applyInArrow(_packed, PACKED), "ann-index")

    # One row per centroid at most.
    sizes = {d: (np.zeros(len(c)), np.zeros(len(c))) for d, c in centroids.items()}
    for r in about.filter(F.col("list").bitwiseAND(F.lit(UNTRAINED)) != UNTRAINED).collect():
        for side, value in zip(sizes[r.list >> 32], (r.n, r.near)):
            side[r.list & UNTRAINED] = value

    probed = "query long, list long, worst double, y binary"
    none = F.lit(None).cast("double")
    begun = asked.select("query", "v", none.alias("worst")).mapInArrow(lambda it: tidy(_probes(it, centroids, sizes, True, k)), probed)
    found = cut(_met(index, begun, k + 1), "ann-first")
    # A class may hold several rows, so the limit is right, if not the least, once k + 1 classes are known.
    limits = found.groupBy("query").agg(F.when(F.count("*") > k, F.max("distance")).alias("worst"))
    others = asked.join(limits, "query", "left").select("query", "v", "worst").mapInArrow(lambda it: tidy(_probes(it, centroids, sizes, False, k)), probed)
    best = _nearest(found.unionByName(_met(index, others, k + 1)), k + 1)

    named = best.select("query", "node").join(asked, "query").join(classes.select("node", "ids", F.col("v").alias("w")), "node")
    own = F.when(F.col("v") == F.col("w"), F.array_position("ids", F.col("vec_id"))).otherwise(F.lit(0)).cast("int")
    others = F.filter("ids", lambda x, i: i + 1 != F.col("own"))
    scored = named.withColumns({"own": own, "score": _cosine(F.col("v"), F.col("w"))}).select("query", F.col("vec_id").alias("query_id"), "score", F.explode(others).alias("vec_id"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op12_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


SQL: dict[str, str] = {}
