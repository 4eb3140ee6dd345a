"""N-gram Jaccard join with adaptive multi-match prefixes, down to the connected classes of near-duplicates.

1. Shingles of all documents are hashed, packed by (chunk of documents, hash bucket) and counted per bucket. Shingles of a
   single document can be in no intersection; only the others, with their document frequency, return to their chunk. A
   document of which fewer than 75 % of shingles occur elsewhere has no partner and drops out of the search.
2. Documents with equal sets form a class, which its smallest id stands for. A class is found in the bucket of its set's hash,
   on the way of the shingles, so that only the tokens of the one that stands for it leave the chunks.
3. Tokens are ordered by document frequency, so that the rarest come first. With ``k`` required matches, the first
   ``n - ceil(0.75 n) + k`` tokens of both of two linked documents share at least ``k``. Each document takes the ``k``
   (and so the prefix) whose estimated cost of reading postings and verifying candidates is lowest.
4. Documents connected through prefix tokens form families; no link leaves a family. Families are verified in blocks: sparse
   token tables of at most some thousand documents are multiplied, pairs that share ``min(k_a, k_b)`` prefix tokens are
   candidates, and their exact intersections decide. A block returns a spanning forest of its links, never its pairs.
5. Components of the forests, joined back to classes and documents.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.components import components
from fogon.llm.store import buckets, cut, prepare
from fogon.llm.words import WORDS, mix, planes, slices, tidied, tidy, unplanes

SHINGLE = 5
PERCENT = 75
CHUNK_SHINGLES = 1_000_000
BUCKETS_PER_PARTITION = 4
BLOCK_DOCS = 1024
VERIFY_COST = 20.0  # verifying a candidate, in postings read

BLOCK = "bucket int, chunk long, docs binary, counts binary, hashes binary, dfs binary, classes binary, about binary"
DOCS = "doc_id long, print long, n_shingles long, near boolean, node long, k int, size int, tokens binary"
SET = np.dtype([("doc", "u4"), ("n", "u4"), ("f1", "u8"), ("f2", "u8"), ("id", "i8"), ("print", "i8")])  # of a class in a chunk
NODE = np.dtype([("doc", "u4"), ("node", "i8")])


def _batch(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], type=kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return first, np.diff(np.r_[first, len(keys)])


def _sums(values: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of consecutive ranges."""
    total = np.r_[np.zeros(1, dtype=np.uint64), np.cumsum(values)]
    return total[ends] - total[ends - counts]


def _equal(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, row that stands for it) of rows of SET: of equal sets that of the smallest id, then text hash, then the first."""
    order = np.lexsort((np.arange(len(sets)), sets["print"], sets["id"], sets["f2"], sets["f1"], sets["n"]))
    s = sets[order]
    new = np.r_[True, (s["n"][1:] != s["n"][:-1]) | (s["f1"][1:] != s["f1"][:-1]) | (s["f2"][1:] != s["f2"][:-1])][: len(s)]
    return order, order[np.flatnonzero(new)][np.cumsum(new) - 1]


def shingle_sets(w, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct k-word shingles of each document of a slice; a shorter text is one shingle."""
    hashes = w.hashes(lower=True)
    counts = w.counts()
    first, win = w.windows(hashes, k)
    doc = w.doc[first]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = (np.cumsum(counts) - counts)[short]
        whole = mix(WORDS.ranges(hashes, begin, begin + counts[short]), 99) + counts[short].astype(np.uint64)
        doc, win = np.r_[doc, short], np.r_[win, whole]
    order = np.lexsort((win, doc))
    doc, win = doc[order], win[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (win[1:] != win[:-1])] if len(doc) else np.zeros(0, dtype=bool)
    return doc[new], win[new]


def _hash_shingles(batches: Iterator[pa.RecordBatch], k: int, dealt: int) -> Iterator[pa.RecordBatch]:
    """Blocks of (chunk, bucket), and one row per chunk about its documents.

    A chunk is numbered by its first document, so that this number and a document's place in the chunk make the document's own.
    A block has the shingles that fall to the bucket, and the sets whose hash does: of equal sets in the chunk, one.
    """
    part, made, before = TaskContext.get().partitionId(), 0, 0
    held: list[tuple[np.ndarray, ...]] = []
    size = seen = 0

    def blocks() -> pa.RecordBatch:
        nonlocal made, before
        ids, prints, valid, n, f1, f2, doc, win = (np.concatenate(x) for x in zip(*held))
        held.clear()
        chunk, about_bucket = (part << 33) | before, (part + made) % dealt
        made += 1
        before += len(ids)
        bucket = ((win >> np.uint64(32)) % np.uint64(dealt)).astype(np.uint32)
        order = np.argsort(bucket, kind="stable")
        out: dict[str, list] = {x.split()[0]: [] for x in BLOCK.split(", ")}

        def row(*values) -> None:
            for key, v in zip(out, values):
                out[key].append(v)

        about = io.BytesIO()
        known = np.flatnonzero(valid & (n > 0))
        sets = np.empty(len(known), dtype=SET)
        for key, values in (("doc", known), ("n", n[known]), ("f1", f1[known]), ("f2", f2[known]), ("id", ids[known]), ("print", prints[known])):
            sets[key] = values
        own, stands = _equal(sets)
        leader = np.arange(len(ids), dtype=np.uint32)
        leader[known[own]] = known[stands]
        sets = sets[np.unique(stands)]
        falls = (sets["f1"] >> np.uint64(32)) % np.uint64(dealt)
        by = np.argsort(falls, kind="stable")
        classes = {int(falls[by[f]]): sets[by[f : f + m]].tobytes() for f, m in zip(*_runs(falls[by]))}
        np.savez(about, ids=ids, prints=prints, valid=valid, n=n, leader=leader)
        row(about_bucket, chunk, None, None, None, None, None, about.getvalue())
        for f, m in zip(*_runs(bucket[order])):
            at = order[f : f + m]
            first, counts = _runs(doc[at])
            b = int(bucket[at[0]])
            row(b, chunk, planes(doc[at][first].astype(np.uint32)), planes(counts.astype(np.uint32)), win[at].tobytes(), None, classes.pop(b, b""), None)
        for b, c in classes.items():
            row(b, chunk, b"", b"", b"", None, c, None)
        return _batch(BLOCK, out)

    for batch in batches:
        col = batch.column(0)
        valid_all = col.is_valid().to_numpy(zero_copy_only=False)
        ids_all, prints_all = col.fill_null(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
        for w in slices(batch.column(1)):
            doc, win = shingle_sets(w, k)
            n = np.bincount(doc, minlength=w.docs)
            ends = np.cumsum(n)
            valid = valid_all[w.first : w.first + w.docs]
            own = valid[doc]
            held.append((ids_all[w.first : w.first + w.docs], prints_all[w.first : w.first + w.docs], valid, n, _sums(mix(win, 1), ends, n), _sums(mix(win, 2), ends, n), doc[own] + seen, win[own]))
            size += len(win)
            seen += w.docs
            if size >= CHUNK_SHINGLES or seen >= CHUNK_SHINGLES:
                yield blocks()
                size = seen = 0
    if held:
        yield blocks()


def _shared(blocks: pa.Table) -> pa.Table:
    """Shingles of one bucket that at least two documents hold, with that number, by chunk; other rows pass.

    For the sets of the bucket, the number of the document that stands for the class (NODE).
    """
    out: dict[str, list] = {x.split()[0]: [] for x in BLOCK.split(", ")}
    rows = blocks.to_pylist()
    full = sorted((r for r in rows if r["about"] is None), key=lambda r: r["chunk"])
    for r in rows:
        if r["about"] is not None:
            for key in out:
                out[key].append(r[key])
    if full:
        hashes = np.concatenate([np.frombuffer(r["hashes"], dtype=np.uint64) for r in full])
        order = np.argsort(hashes, kind="stable")
        df = np.empty(len(hashes), dtype=np.uint32)
        _, m = _runs(hashes[order])
        df[order] = np.repeat(m, m)
        sets = [np.frombuffer(r["classes"], dtype=SET) for r in full]
        number = np.concatenate([s["doc"].astype(np.int64) + r["chunk"] for r, s in zip(full, sets)])
        nodes = np.empty(len(number), dtype=NODE)
        nodes["doc"] = np.concatenate([s["doc"] for s in sets])
        row, stands = _equal(np.concatenate(sets))
        nodes["node"][row] = number[stands]
        at = 0
        for r, nodes_of in zip(full, np.split(nodes, np.cumsum([len(s) for s in sets])[:-1])):
            c = unplanes(r["counts"], np.uint32)
            end = at + int(c.sum())
            own = df[at:end] > 1
            if own.any() or len(nodes_of):
                doc = np.repeat(unplanes(r["docs"], np.uint32), c)[own]
                first, counts = _runs(doc)
                values = (r["bucket"], r["chunk"], planes(doc[first]), planes(counts.astype(np.uint32)), hashes[at:end][own].tobytes(), planes(df[at:end][own]), nodes_of.tobytes(), None)
                for key, v in zip(out, values):
                    out[key].append(v)
            at = end
    return pa.Table.from_batches([_batch(BLOCK, out)])


def _documents(blocks: pa.Table, percent: int) -> pa.Table:
    """One row per document of a chunk; shared tokens, rarest first, and the prefix for those that stand for their class.

    node is the number of the document that stands for the class, if enough shingles are shared.
    """
    rows = blocks.to_pylist()
    about = np.load(io.BytesIO(next(r["about"] for r in rows if r["about"] is not None)))
    ids, prints, valid, n, leader = (about[x] for x in ("ids", "prints", "valid", "n", "leader"))
    full = [r for r in rows if r["about"] is None]
    none = np.zeros(0, dtype=np.uint64)
    win = np.concatenate([none, *(np.frombuffer(r["hashes"], dtype=np.uint64) for r in full)])
    df = np.concatenate([none[:0].astype(np.uint32), *(unplanes(r["dfs"], np.uint32) for r in full)])
    doc = np.concatenate([none.astype(np.int64), *(np.repeat(unplanes(r["docs"], np.uint32), unplanes(r["counts"], np.uint32)) for r in full)]).astype(np.int64)
    shared = np.bincount(doc, minlength=len(ids))
    near = (n > 0) & valid & (100 * shared >= percent * n)
    node = np.full(len(ids), -1, dtype=np.int64)
    for r in full:
        nodes = np.frombuffer(r["classes"], dtype=NODE)
        node[nodes["doc"]] = nodes["node"]
    node = node[leader]
    carries = near & (node == rows[0]["chunk"] + np.arange(len(ids)))
    keep = carries[doc]
    win, df, doc = win[keep], df[keep], doc[keep]
    o = np.lexsort((win, df, doc))
    win, df, doc = win[o], df[o], doc[o]
    ends = np.cumsum(np.bincount(doc, minlength=len(ids)))
    begins = np.r_[0, ends[:-1]]
    order = np.lexsort((prints, n, ids))
    pre = {i: prefix(int(n[i]), df[begins[i] : ends[i]], percent) for i in np.flatnonzero(carries)}
    out = {
        "doc_id": [int(ids[i]) if valid[i] else None for i in order],
        "print": prints[order],
        "n_shingles": n[order],
        "near": near[order],
        "node": [int(node[i]) if near[i] else None for i in order],
        "k": [pre[i][0] if carries[i] else None for i in order],
        "size": [pre[i][1] if carries[i] else None for i in order],
        "tokens": [win[begins[i] : ends[i]].tobytes() if carries[i] else None for i in order],
    }
    return pa.Table.from_batches([_batch(DOCS, out)])


def prefix(n: int, dfs: np.ndarray, percent: int) -> tuple[int, int]:
    """Required matches and number of shared tokens in the prefix, of lowest estimated cost.

    dfs: document frequencies of the tokens that occur elsewhere, ascending; the other n - len(dfs) tokens come first
    in the order and can match nothing.
    """
    need = -(-percent * n // 100)
    k = 1 << np.arange(int(need).bit_length())
    k = k[k <= need]
    size = np.clip(n - need + k - (n - len(dfs)), 0, len(dfs))
    read = np.r_[0.0, np.cumsum(dfs - 1.0)][size]
    best = int(np.argmin(read + VERIFY_COST * read / k))
    return int(k[best]), int(size[best])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, rep) for the prefix tokens of each class."""
    for batch in batches:
        tokens, reps = [], []
        for rep, size, t in zip(*(c.to_pylist() for c in batch.columns)):
            tokens.append(np.frombuffer(t, dtype=np.int64)[:size])
            reps.append(np.full(size, rep, dtype=np.int64))
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(reps))], names=["token", "rep"])


def _common(rows: list[np.ndarray], a: np.ndarray, b: np.ndarray, stripe: int = 4096) -> np.ndarray:
    """Number of common tokens of rows a (down) and rows b (across)."""
    used = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *(rows[i] for i in a)]))
    out = np.zeros((len(a), len(b)), dtype=np.float32)

    def places(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.concatenate([np.zeros(0, dtype=np.int64), *(np.full(len(rows[i]), x) for x, i in enumerate(which))])
        t = np.concatenate([np.zeros(0, dtype=np.uint64), *(rows[i] for i in which)])
        col = np.searchsorted(used, t)
        col[col == len(used)] = 0
        own = used[col] == t if len(used) else np.zeros(len(t), dtype=bool)
        return at[own].astype(np.int64), col[own]

    (ra, ca), (rb, cb) = places(a), places(b)
    for low in range(0, len(used), stripe):
        def table(r: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
            m = (c >= low) & (c < low + stripe)
            x = np.zeros((n, min(stripe, len(used) - low)), dtype=np.float32)
            x[r[m], c[m] - low] = 1
            return x

        out += table(ra, ca, len(a)) @ table(rb, cb, len(b)).T
    return out


def linked(tokens: list[np.ndarray], n: np.ndarray, k: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the documents a (down) and b (across) link: prefix candidates, then exact similarity."""
    short = [t[:m] for t, m in zip(tokens, size)]
    fits = (100 * np.minimum.outer(n[a], n[b]) >= percent * np.maximum.outer(n[a], n[b]))
    candidate = fits & (_common(short, a, b) >= np.minimum.outer(k[a], k[b]))
    out = np.zeros(candidate.shape, dtype=bool)
    r, c = np.flatnonzero(candidate.any(axis=1)), np.flatnonzero(candidate.any(axis=0))
    if len(r) and len(c):
        common = _common(tokens, a[r], b[c]).astype(np.int64)
        union = np.add.outer(n[a[r]], n[b[c]]) - common
        out[np.ix_(r, c)] = candidate[np.ix_(r, c)] & (100 * common >= percent * union)
    return out


def _forest(block: pa.Table, percent: int) -> pa.Table:
    """Spanning links (a, b) of one block of families, or of one pair of blocks of a large family."""
    family, part, rep, n, k, size = (np.array(block.column(x).to_pylist(), dtype=np.int64) for x in ("family", "part", "rep", "n_shingles", "k", "size"))
    tokens = [np.frombuffer(x, dtype=np.uint64) for x in block.column("tokens").to_pylist()]
    order = np.lexsort((rep, part, family))
    made_a, made_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for f, m in zip(*_runs(family[order])):
        own = order[f : f + m]
        sides = np.unique(part[own])
        a, b = own[part[own] == sides[0]], own[part[own] == sides[-1]]
        both = np.unique(np.r_[a, b])
        local = [x for x in both]
        at = {int(x): i for i, x in enumerate(local)}
        la, lb = np.array([at[int(x)] for x in a]), np.array([at[int(x)] for x in b])
        hit = linked([tokens[x] for x in local], n[both], k[both], size[both], la, lb, percent)
        ids = rep[both]
        label = ids.copy()
        while True:  # the smallest id near each document, until nothing changes
            big = np.iinfo(np.int64).max
            down = np.where(hit, label[lb][None, :], big).min(axis=1)
            new = label.copy()
            np.minimum.at(new, la, down)
            across = np.where(hit, new[la][:, None], big).min(axis=0)
            np.minimum.at(new, lb, across)
            if (new == label).all():
                break
            label = new
        move = label != ids
        made_a.append(ids[move])
        made_b.append(label[move])
    return pa.table({"a": np.concatenate(made_a), "b": np.concatenate(made_b)})


def _block_rows(reps: DataFrame, families: DataFrame, small: int) -> DataFrame:
    """Rows of each class for each block that verifies it: (block, family, part, rep, n_shingles, k, size, tokens).

    Families of up to BLOCK_DOCS classes share blocks by hash. A larger family is dealt to parts by hash, and each pair of
    parts is a block, so that no task holds more than two parts.
    """
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    placed = families.join(sizes, "family").withColumn("parts", F.ceil(F.col("size") / BLOCK_DOCS).cast("long"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    placed = placed.withColumn("other", other)
    key = F.when(F.col("parts") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("family"), F.lit(small)).cast("string"))).otherwise(
        F.concat_ws(":", "family", F.least("part", "other"), F.greatest("part", "other")))
    return placed.select(key.alias("block"), "family", "part", "rep").join(reps, "rep")


def _linked(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of docs (DOCS), classes of equal sets (node, least: the smallest row) and spanning links (a, b) of nodes."""
    prepare(docs.sparkSession)
    dealt = buckets(docs, "text", BUCKETS_PER_PARTITION)
    blocks = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(lambda it: tidy(_hash_shingles(it, shingle, dealt)), BLOCK)
    shared = blocks.groupBy("bucket").applyInArrow(lambda t: tidied(_shared(t)), BLOCK)
    table = cut(shared.groupBy("chunk").applyInArrow(lambda t: tidied(_documents(t, percent)), DOCS), "jaccard-docs")

    stand = table.filter("k is not null")
    classes = stand.select("node", F.struct("doc_id", "print").alias("least"))
    reps = stand.select(F.col("node").alias("rep"), "n_shingles", "k", "size", "tokens")

    entries = reps.select("rep", "size", "tokens").mapInArrow(lambda it: tidy(_entries(it)), "token long, rep long")
    least = entries.groupBy("token").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least < most")
    stars = entries.join(least, "token").filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    member = components(stars, "jaccard-families")
    families = member.select(F.col("node").alias("rep"), F.col("component").alias("family")).union(
        member.select(F.col("component").alias("rep"), F.col("component").alias("family")).distinct())
    forests = _block_rows(reps, families, dealt).groupBy("block").applyInArrow(lambda t: tidied(_forest(t, percent)), "a long, b long")
    return table, classes, forests


def _leads(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, lead): the smallest row (doc_id, print) of the component of each class."""
    found = components(links, "jaccard-links")
    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("lead"))
    return named.join(smallest, "component").select("node", "lead")


def jaccard_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Null, empty and wordless texts have no shingles and link with nothing. Rows of one doc_id are one node: what any of their texts reaches,
    all of them do. A null doc_id links with nothing and has a null component. Other columns are ignored.
    """
    table, classes, links = _linked(docs, shingle, percent)
    near = table.filter("near").select("doc_id", "n_shingles", "node")
    # Texts of one doc_id that are of several classes join these.
    mixed = near.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("doc_id")
    own = near.join(mixed, "doc_id", "left_semi").select("doc_id", "node")
    twins = own.join(own.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b").distinct()
    named = near.join(_leads(classes, links.union(twins)), "node", "left").select("doc_id", "n_shingles", F.col("lead.doc_id").alias("component_id"))
    of_id = named.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    rest = table.filter("not near").select("doc_id", "n_shingles").join(of_id, "doc_id", "left")
    return named.union(rest.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def first_of_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, print): rows of which no row with a smaller doc_id (then xxhash64 of the text, which is print) is reached by links.

    Here every row stands for itself, also those of one doc_id: a row leaves only because of its own text. Equal rows have one entry.
    Rows with a null doc_id are left out.
    """
    table, classes, links = _linked(docs, shingle, percent)
    leads = _leads(classes, links).select("lead.doc_id", "lead.print").distinct()
    return leads.union(table.filter("not near and doc_id is not null").select("doc_id", "print").distinct())


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = {
    "op8_jaccard_join": r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
sh as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) as i from w)),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
link as (
  select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 75 * (na.n + nb.n - c)),
reach as (
  select doc_id as s, doc_id as t from documents
  union
  select reach.s, l.b from reach join (select a, b from link union all select b, a from link) l on l.a = reach.t)
select documents.doc_id, coalesce(n, 0)::bigint as n_shingles, m as component_id
from documents left join n using (doc_id) join (select s, min(t) as m from reach group by s) on s = documents.doc_id"""
}
