"""Embedding near-dedup by lattice hashing.

In each of several tables, a vector's random projections are cut into blocks of eight coordinates and every block is decoded to
its nearest point of the E8 lattice. The points together name the vector's cell. A vector is also placed in the cells of
its nearest neighbouring lattice points (probes), so a pair meets if one's cell is among the other's cells in any table.

Cells are dealt out by key. A cell with many vectors is split into parts, and each pair of parts is a block of its own. A block
multiplies its vectors in double precision and keeps the pairs of cosine 0.95 or more. A pair that meets in several places is
counted in the first of them only, which both rows show (they carry all their cells), so pairs are never emitted: a block
returns link counts per vector and a spanning forest.

Equal vectors are one class, which takes part once with its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.components import components
from fogon.llm.store import cut, partitions, prepare
from fogon.llm.words import mix, tidied, tidy

COSINE = 0.95
TABLES = 8
BLOCKS = 2  # lattice blocks of a table
PROBES = 4
SCALE = 0.22  # of the lattice, for unit vectors projected with orthonormal rows of a 64-dimensional space
SEED = 20_240_607
PART = 512  # vectors of a cell that meet in one part
BLOCK_ROWS = 20_000  # rows of small cells that share a block, about


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: differences to a point's nearest neighbours."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        signs = np.array([1 - 2 * (bits >> k & 1) for k in range(8)])
        if (signs < 0).sum() % 2 == 0:
            out.append(signs / 2)
    return np.array(out)


ROOTS = roots()


def decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    gap = x[odd] - near[odd]
    worst = np.abs(gap).argmax(axis=1)
    near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 shifted by one half."""
    whole, half = decode_d8(x), decode_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


def projections(dimension: int, tables: int = TABLES, blocks: int = BLOCKS) -> np.ndarray:
    """Random matrices (tables, 8 * blocks, dimension), their rows orthonormal where the dimension allows."""
    random = np.random.Generator(np.random.PCG64(SEED))
    out = []
    for _ in range(tables):
        rows = []
        while sum(map(len, rows)) < 8 * blocks:
            q, _ = np.linalg.qr(random.standard_normal((dimension, dimension)))
            rows.append(q.T)
        out.append(np.concatenate(rows)[: 8 * blocks])
    return np.array(out)


def _name(points: np.ndarray, table: int, block: int) -> np.ndarray:
    """Hash of lattice points (rows), to be added up over the blocks of a table."""
    twice = np.rint(2 * points).astype(np.int64).view(np.uint64)
    h = np.full(len(points), (table + 1) * 1009 + block, dtype=np.uint64)
    for i in range(8):
        h = mix(h ^ mix(twice[:, i], i), block)
    return h


def cells(unit: np.ndarray, matrices: np.ndarray, scale: float, probes: int) -> np.ndarray:
    """Keys (vector, table, 1 + probes): the own cell first, then the neighbouring ones, nearest first."""
    n, blocks = len(unit), matrices.shape[1] // 8
    dimension = unit.shape[1]
    keys = np.empty((n, len(matrices), 1 + probes), dtype=np.uint64)
    for t, m in enumerate(matrices):
        x = (unit @ m.T) * (np.sqrt(dimension / 64) / scale)
        points = [decode_e8(x[:, 8 * b : 8 * b + 8]) for b in range(blocks)]
        names = [_name(p, t, b) for b, p in enumerate(points)]
        own = np.sum(names, axis=0, dtype=np.uint64)
        keys[:, t, 0] = own
        nearness = np.concatenate([(x[:, 8 * b : 8 * b + 8] - points[b]) @ ROOTS.T for b in range(blocks)], axis=1)
        best = np.argsort(-nearness, axis=1, kind="stable")[:, :probes] if probes else np.zeros((n, 0), dtype=int)
        for p in range(best.shape[1]):
            block, root = best[:, p] // len(ROOTS), best[:, p] % len(ROOTS)
            for b in range(blocks):
                at = np.flatnonzero(block == b)
                moved = _name(points[b][at] + ROOTS[root[at]], t, b)
                keys[at, t, 1 + p] = own[at] - names[b][at] + moved
    return keys


def _placed(batches: Iterator[pa.RecordBatch], tables: int, blocks: int, probes: int, scale: float) -> Iterator[pa.RecordBatch]:
    """rep, size, vector -> rep, size, unit vector, keys of all cells (per table: the own one, then the probes)."""
    for batch in batches:
        reps, sizes = (batch.column(i).to_numpy() for i in (0, 1))
        vectors = batch.column(2)
        lengths = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(lengths)
        for d in np.unique(lengths):
            rows = np.flatnonzero(lengths == d)
            x = np.stack([flat[ends[i] - d : ends[i]] for i in rows])
            x = x / np.abs(x).max(axis=1)[:, None]
            unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
            keys = cells(unit, projections(int(d), tables, blocks), scale, probes)
            flat_keys = keys.reshape(len(rows), -1).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(reps[rows]), pa.array(sizes[rows]), pa.array([u.tobytes() for u in unit], type=pa.binary()),
                pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * flat_keys.shape[1], flat_keys.reshape(-1))],
                names=["rep", "size", "unit", "keys"])


def _count(block: pa.Table, per_table: int, cosine: float) -> pa.Table:
    """Links of the cells, or the pair of parts of one cell, in a block: (rep, links, label)."""
    cell, part, low, high = (block.column(c).to_numpy() for c in ("cell", "part", "low", "high"))
    home, rep, size = (block.column(c).to_numpy() for c in ("home", "rep", "size"))
    keys = block.column("keys").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(cell), -1)
    raw = [np.frombuffer(v, dtype=np.float64) for v in block.column("unit").to_pylist()]
    order = np.lexsort((part, cell))
    first = np.flatnonzero(np.r_[True, cell[order][1:] != cell[order][:-1]])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for f, n in zip(first, np.diff(np.r_[first, len(order)])):
        own = order[f : f + n]
        if n < 2 or not home[own].any():
            continue
        sides = low[own[0]], high[own[0]]
        for d in {len(raw[i]) for i in own}:
            same = np.array([i for i in own if len(raw[i]) == d])
            a, b = same[part[same] == sides[0]], same[part[same] == sides[1]]
            if not len(a) or not len(b):
                continue
            hit = np.stack([raw[i] for i in a]) @ np.stack([raw[i] for i in b]).T >= cosine
            hit &= home[a][:, None] | home[b][None, :]
            if sides[0] == sides[1]:
                hit &= rep[a][:, None] < rep[b][None, :]
            r, c = np.nonzero(hit)
            if not len(r):
                continue
            x, y = a[r], b[c]
            once = first_meeting(keys[x], keys[y], per_table) == cell[own[0]].astype(np.int64).view(np.uint64)
            x, y = x[once], y[once]
            ids, at = np.unique(np.r_[rep[x], rep[y]], return_inverse=True)
            links = np.bincount(at, weights=np.r_[size[y], size[x]]).astype(np.int64) if len(ids) else np.zeros(0, dtype=np.int64)
            label = ids.copy()
            ax, ay = at[: len(x)], at[len(x) :]
            while len(ids):
                least = np.minimum(label[ax], label[ay])
                new = label.copy()
                np.minimum.at(new, ax, least)
                np.minimum.at(new, ay, least)
                if (new == label).all():
                    break
                label = new
            out.append((ids, links, label))
    joined = [np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 3
    return pa.table({"rep": joined[0], "links": joined[1], "label": joined[2]})


def first_meeting(a: np.ndarray, b: np.ndarray, per_table: int) -> np.ndarray:
    """Key of the first cell, in the order of tables and of (own cells, probes), in which rows a and b meet.

    They meet where one's own cell is among the other's cells. Rows that meet nowhere give 0.
    """
    out = np.zeros(len(a), dtype=np.uint64)
    free = np.ones(len(a), dtype=bool)
    for t in range(0, a.shape[1], per_table):
        own_a, own_b = a[:, t], b[:, t]
        at_a = (b[:, t : t + per_table] == own_a[:, None]).any(axis=1)
        at_b = (a[:, t : t + per_table] == own_b[:, None]).any(axis=1)
        # Both ways in one table: the smaller key.
        key = np.where(at_a & at_b, np.minimum(own_a, own_b), np.where(at_a, own_a, own_b))
        new = free & (at_a | at_b)
        out[new] = key[new]
        free &= ~new
    return out


def link_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding).

    A vector that is null, empty, zero or holds null or non-finite components links with nothing, and neither does one of a null vec_id. Vectors of
    different lengths don't link. Copies (equal vectors) link with each other. n_links counts the other rows that a row is linked with, copies and
    near rows of its own vec_id included. Rows of one vec_id are one node as regards components: what any of them reaches, all of them do.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.filter(fine).select("vec_id", "v", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2"))
    same = ["h1", "h2", "v"]
    classes = good.groupBy(*same).agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("rep"), "least", "size", *same), "lattice-classes")

    table = cut(classes.select("rep", "size", "v").mapInArrow(
        lambda it: tidy(_placed(it, tables, blocks, probes, scale)), "rep long, size long, unit binary, keys array<long>"), "lattice-cells")
    placed = table.select("rep", F.posexplode("keys").alias("at", "cell")).select("rep", "cell", (F.col("at") % (1 + probes) == 0).alias("home"))
    crowd = cut(placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("any")).filter((F.col("n") > 1) & F.col("any")), "lattice-crowd")
    small = max(4 * partitions(spark), (crowd.agg(F.sum("n")).first()[0] or 0) // BLOCK_ROWS)
    dealt = placed.join(crowd.select("cell", F.ceil(F.col("n") / PART).cast("long").alias("parts")), "cell")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    key = F.when(F.col("parts") == 1, F.concat(F.lit("s"), F.pmod("cell", F.lit(small)).cast("string"))).otherwise(
        F.concat_ws(":", "cell", F.least("part", "other"), F.greatest("part", "other")))
    dealt = dealt.withColumns({"block": key, "low": F.least("part", "other"), "high": F.greatest("part", "other")}).join(table, "rep")
    counted = dealt.select("block", "cell", "part", "low", "high", "home", "rep", "size", "unit", "keys").groupBy("block").applyInArrow(
        lambda t: tidied(_count(t, 1 + probes, cosine)), "rep long, links long, label long")
    counted = cut(counted, "lattice-links")

    links = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = counted.select(F.col("rep").alias("a"), F.col("label").alias("b")).union(_one_id(good, classes, same, "vec_id", "rep"))
    found = components(joined, "lattice")
    named = classes.join(links, "rep", "left").join(found, classes.rep == found.node, "left").select(
        *same, "least", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    out = good.join(named.join(smallest, "component"), same).select("vec_id", "n_links", "component_id")
    # A vector that takes no part still is of its vec_id's node.
    rest = rows.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    of_id = out.groupBy("vec_id").agg(F.min("component_id").alias("component_id"))
    rest = rest.join(of_id, "vec_id", "left").select("vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _one_id(rows: DataFrame, classes: DataFrame, same: list[str], key: str, node: str) -> DataFrame:
    """Edges (a, b) between the classes of each id whose rows are of several classes, from every one to the smallest."""
    mixed = rows.groupBy(key).agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi")).filter("lo <> hi").select(key)
    own = rows.join(mixed, key, "left_semi").join(classes.select(*same, node), same).select(key, node)
    return own.join(own.groupBy(key).agg(F.min(node).alias("least")), key).select(F.col(node).alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = {
    "op2_lattice_dedup": """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
link as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (
  select vec_id as s, vec_id as t from v
  union
  select reach.s, link.b from reach join link on link.a = reach.t),
least_id as (select s, min(t) as m from reach group by s)
select vec_id, (select count(*) from link where a = vec_id)::bigint as n_links, m as component_id, vec_id = m as kept
from v join least_id on s = vec_id"""
}
