"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark by hash bucket.

1. Each task hashes every window of its documents in chunks. A chunk keeps one occurrence of each hash, in its least document: occurrences in
   greater ones are later wherever else the hash is, and further ones in the least document share the fate of the one kept.
   One row per (chunk, bucket) carries the kept hashes and their places as packed arrays: about nine bytes a window. One row per
   chunk carries its documents and the other occurrences.
2. The bucket's task finds the least document of its hashes over all chunks. Windows that also start in a document with a smaller id
   go back to their chunk.
3. A chunk merges the repeated windows of each document into maximal intervals of covered words.
4. Documents are joined with their intervals by id and text (64 bits of hash), and cut.

A hash is in a bucket at most once per chunk of two million windows, so neither a passage that a third of all documents hold nor a long text that
repeats a word makes a bucket larger than others. Two windows count as equal when 64 bits of hash and the bucket agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import buckets, prepare
from fogon.llm.words import planes, slices, tidied, tidy, unplanes

WINDOW = 50
CHUNK_WINDOWS = 2_000_000
BUCKETS_PER_PARTITION = 4

# Bucket -1 - chunk: the row of the chunk itself. Its docs, prints and counts (of words) are those of its documents, its places are later ones
# for certain, its copies are places that are later if the ones in heads are.
BLOCK = "bucket long, chunk long, docs binary, counts binary, hashes binary, places binary, prints binary, copies binary, heads binary"
FOUND = "chunk long, docs binary, counts binary, places binary, prints binary, copies binary, heads binary"
SPANS = "doc_id long, print long, spans binary"


def _arrow(schema: str, **columns: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], type=kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal values."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return first, np.diff(np.r_[first, len(keys)])


def _pack_places(place: np.ndarray) -> bytes:
    """Places as steps from the one before."""
    return planes(np.diff(place, prepend=0).astype(np.uint32))


def _unpack_places(places: bytes) -> np.ndarray:
    return np.cumsum(unplanes(places, np.uint32).astype(np.int64))


def _chunk(part: int, made: int, buckets: int, rows: list[np.ndarray], owner: np.ndarray, place: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """Rows of one chunk. Its documents (ids, prints, words) lie one after another, so places are unique and ascend."""
    ids, prints, words = rows
    doc = ids[owner]
    order = np.argsort(hashes, kind="stable")
    first, size = _runs(hashes[order])
    own = doc[order]
    least = np.repeat(np.minimum.reduceat(own, first), size)
    later = np.sort(order[own > least])
    at = np.flatnonzero(own == least)
    run = np.repeat(np.arange(len(first)), size)[at]
    head = np.r_[True, run[1:] != run[:-1]]
    heads = order[at[head]]
    copies, of = order[at[~head]], heads[run[~head]]
    by_place = np.argsort(copies)
    copies, of = copies[by_place], of[by_place]
    # Rows of another order, as a repeated task could meet them, are another chunk.
    name = hashlib.blake2b(b"".join([np.array([part, made]).tobytes(), *(x.tobytes() for x in rows)]), digest_size=8).digest()
    chunk = int.from_bytes(name, "little") >> 1
    out: dict[str, list] = {n: [v] for n, v in (
        ("bucket", -1 - chunk), ("chunk", chunk), ("docs", planes(ids)), ("counts", planes(words.astype(np.uint32))), ("hashes", None),
        ("places", _pack_places(place[later])), ("prints", planes(prints)), ("copies", _pack_places(place[copies])), ("heads", planes(place[of])))}
    heads = np.sort(heads)
    bucket = (hashes[heads] >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket.astype(np.uint32), kind="stable")
    for f, n in zip(*_runs(bucket[order])):
        at = heads[order[f : f + n]]
        starts, counts = _runs(doc[at])
        values = (int(bucket[order[f]]), chunk, planes(doc[at][starts]), planes(counts.astype(np.uint32)), hashes[at].tobytes(), _pack_places(place[at]), None, None, None)
        for k, v in zip(out, values):
            out[k].append(v)
    return _arrow(BLOCK, **out)


def _hash_windows(batches: Iterator[pa.RecordBatch], window: int, buckets: int, chunk_windows: int) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, ...]] = []
    rows = base = size = 0

    def blocks() -> pa.RecordBatch:
        ids, prints, words, owner, place, hashes = (np.concatenate(x) for x in zip(*held))
        held.clear()
        return _chunk(part, made, buckets, [ids, prints, words], owner, place, hashes)

    for batch in batches:
        ids, prints = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2))
        for w in slices(batch.column(1)):
            if len(w.starts) < window:
                continue
            first, hashes = w.windows(w.hashes(), window)
            if not len(first):
                continue
            counts = w.counts()
            long = np.flatnonzero(counts >= window)
            words = counts[long].astype(np.int64)
            number, shift = np.zeros(len(counts), dtype=np.int64), np.zeros(len(counts), dtype=np.int64)
            number[long] = rows + np.arange(len(long))
            shift[long] = base + np.cumsum(words) - words - (np.cumsum(counts) - counts)[long]
            doc = w.doc[first]
            held.append((ids[w.first + long], prints[w.first + long], words, number[doc], first + shift[doc], hashes))
            rows, base, size = rows + len(long), base + int(words.sum()), size + len(first)
            if size >= chunk_windows:
                yield blocks()
                made, rows, base, size = made + 1, 0, 0, 0
    if held:
        yield blocks()


def _repeated(blocks: pa.Table) -> pa.Table:
    """Windows of one bucket whose hash also starts in a document with a smaller id, by chunk. Rows of chunks pass."""
    if blocks.column("bucket")[0].as_py() < 0:
        return blocks.select([x.split()[0] for x in FOUND.split(", ")])
    cols = {n: blocks.column(n).to_pylist() for n in ("chunk", "docs", "counts", "hashes")}
    hashes = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in cols["hashes"]])
    docs = np.concatenate([np.repeat(unplanes(d, np.int64), unplanes(c, np.uint32)) for d, c in zip(cols["docs"], cols["counts"])])
    order = np.argsort(hashes, kind="stable")
    first, size = _runs(hashes[order])
    later = np.zeros(len(hashes), dtype=bool)
    later[order] = docs[order] > np.repeat(np.minimum.reduceat(docs[order], first), size)
    chunks, found = [], []
    places = blocks.column("places")
    at = 0
    for i, x in enumerate(cols["hashes"]):
        own = later[at : at + len(x) // 8]
        at += len(own)
        if own.any():
            chunks.append(cols["chunk"][i])
            found.append(_pack_places(_unpack_places(places[i].as_py())[own]))
    none = [None] * len(chunks)
    return pa.Table.from_batches([_arrow(FOUND, chunk=chunks, docs=none, counts=none, places=found, prints=none, copies=none, heads=none)])


def _intervals(found: pa.Table, window: int) -> pa.Table:
    """Maximal intervals [start, end) of removed words of each document of a chunk."""
    own = [i for i, x in enumerate(found.column("docs")) if x.is_valid]
    if len(own) != 1:
        raise RuntimeError("the input changed its order between two attempts of a task; write it as a table first")
    row = {n: found.column(n)[own[0]].as_py() for n in found.column_names}
    sent = [_unpack_places(x) for i, x in enumerate(found.column("places").to_pylist()) if i != own[0]]
    heads = np.sort(np.concatenate(sent)) if sent else np.zeros(0, dtype=np.int64)
    copies = _unpack_places(row["copies"])[np.isin(unplanes(row["heads"], np.int64), heads)]
    place = np.sort(np.concatenate([heads, _unpack_places(row["places"]), copies]))
    docs, prints, words = unplanes(row["docs"], np.int64), unplanes(row["prints"], np.int64), unplanes(row["counts"], np.uint32).astype(np.int64)
    begin = np.cumsum(words) - words
    doc = np.searchsorted(begin, place, side="right") - 1
    new = np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + window)] if len(place) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(place)][: len(first)] - 1
    spans = np.stack([place[first] - begin[doc[first]], place[last] + window - begin[doc[first]]], axis=1).astype(np.uint32)
    at, n = _runs(doc[first])
    named = doc[first][at]
    return pa.Table.from_batches([_arrow(SPANS, doc_id=docs[named], print=prints[named], spans=[spans[a : a + k].tobytes() for a, k in zip(at, n)])])


def removal_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, print, spans): word intervals to remove, as pairs of little-endian unsigned 32-bit numbers, one row for each doc_id and
    text (``print`` is its xxhash64) with any.

    Null, empty and short texts have no window. Rows with equal doc_id count as one document and do not repeat each other;
    rows with a null doc_id are left out, as "smaller" says nothing about them.
    """
    prepare(docs.sparkSession)
    dealt, chunk_windows = buckets(docs, "text", BUCKETS_PER_PARTITION), CHUNK_WINDOWS
    blocks = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print")).mapInArrow(
        lambda it: tidy(_hash_windows(it, window, dealt, chunk_windows)), BLOCK)
    found = blocks.groupBy("bucket").applyInArrow(lambda t: tidied(_repeated(t)), FOUND)
    spans = found.groupBy("chunk").applyInArrow(lambda t: tidied(_intervals(t, window)), SPANS)
    # Rows of one doc_id and text lose the same words, whichever their chunks.
    return spans.groupBy("doc_id", "print").agg(F.first("spans").alias("spans"))


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, spans -> doc_id, n_words, n_removed, kept text."""
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
        for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            words = (text or "").encode().split()
            n = len(words)
            for a, b in reversed(np.frombuffer(spans or b"", dtype=np.uint32).reshape(-1, 2).tolist()):
                del words[a:b]
            for k, v in zip(out, (doc, n, n - len(words), b" ".join(words).decode())):
                out[k].append(v)
        yield _arrow("doc_id long, n_words long, n_removed long, kept string", **out)


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words of windows that an earlier document holds.

    Kept words are joined by one space. Null text: no words. Other columns are ignored; repeated rows stay repeated, and
    of rows of one doc_id each loses the words of its own text only.
    """
    spans = removal_spans(docs, window)
    named = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print"))
    joined = named.join(spans, ["doc_id", "print"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(lambda it: tidy(_cut_texts(it)), "doc_id long, n_words long, n_removed long, kept string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = {
    "op4_substring_dedup": r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
win as (
  select doc_id, i, array_to_string(ws[i:i + 49], ' ') as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w)),
least_doc as (select g, min(doc_id) as m from win group by g),
hit as (select doc_id, i from win join least_doc using (g) where doc_id > m),
cov as (select distinct doc_id, unnest(range(i, i + 50)) as p from hit),
pos as (select doc_id, ws[p] as word, p from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as p from w)),
keep as (
  select doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
  from pos anti join cov using (doc_id, p) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join keep using (doc_id)"""
}
