"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are split by the vocabulary's pattern. A chunk of documents keeps each of its distinct words once; its documents become
   sequences of word numbers, the most frequent words having the smallest.
2. Words travel by hash bucket, packed with their numbers in the chunk. A bucket sees every word of its share of all words, and
   encodes each distinct one once, however many chunks hold it.
   Words and sequences are made by two passes over the texts: splitting again is cheaper than moving the sequences twice.
3. The ids go back to the chunks, are joined with the sequences by word number and reassembled by position.

A word that makes up a third of all text is one entry per chunk. Decoding joins ids with the token-byte table, which is as
large as the vocabulary and is built in each task.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import buckets, prepare
from fogon.llm.words import planes, tidied, tidy, unplanes

CHUNK_CHARS = 16_000_000
BUCKETS_PER_PARTITION = 4

CHUNK = "chunk long, bucket int, numbers binary, lengths binary, words binary, docs binary, valid binary, counts binary, sequence binary"
ENCODED = "doc_id long, n_tokens long, ids binary"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: lines of base64 and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in CHUNK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], type=kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _explode(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int | None) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> one row per bucket with the words of a chunk or, without buckets, one row with its sequences.

    A chunk's id depends on its documents and words, so rows of two passes that differ never meet.
    """
    import regex
    import zstandard

    split = regex.compile(pattern).findall
    pack = zstandard.ZstdCompressor(level=3).compress
    part, made, size = TaskContext.get().partitionId(), 0, 0
    numbers, ids, sequences = Numbers(), [], []

    def close() -> pa.RecordBatch:
        nonlocal made
        raw = [w.encode() for w in numbers]
        docs = np.array([i or 0 for i in ids], dtype=np.int64).tobytes()
        chunk = (zlib.crc32(b"\0".join(raw), zlib.crc32(docs)) << 31) | (zlib.crc32(b"%d:%d" % (part, made)) >> 1)
        made += 1
        counts = np.array([len(s) for s in sequences], dtype=np.uint32)
        flat = np.concatenate([np.zeros(0, dtype=np.uint32), *sequences])
        order = np.argsort(-np.bincount(flat, minlength=len(numbers)), kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        if buckets is None:
            head = {"chunk": chunk, "docs": docs, "valid": bytes(i is not None for i in ids), "counts": planes(counts), "sequence": pack(planes(rank[flat]))}
            numbers.clear(), ids.clear(), sequences.clear()
            return _batch([head])
        rows = []
        bucket = np.array([zlib.crc32(w) for w in raw], dtype=np.uint32) % np.uint32(buckets)
        lengths = np.array([len(w) for w in raw], dtype=np.uint32)
        by_bucket = np.lexsort((rank, bucket))
        first = np.flatnonzero(np.r_[True, np.diff(bucket[by_bucket]) != 0]) if len(raw) else []
        for at in np.split(by_bucket, first[1:]) if len(raw) else []:
            rows.append({"chunk": chunk, "bucket": int(bucket[at[0]]), "numbers": pack(planes(np.diff(rank[at], prepend=np.uint32(0)).astype(np.uint32))),
                         "lengths": pack(planes(lengths[at])), "words": pack(b"".join([raw[i] for i in at]))})
        numbers.clear(), ids.clear(), sequences.clear()
        return _batch(rows)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = split(text.as_py() or "")
            ids.append(doc)
            sequences.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words)))
            size += sum(map(len, words)) + 50
            if size >= CHUNK_CHARS:
                yield close()
                size = 0
    if ids:
        yield close()


def _cut_bytes(raw: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


@lru_cache(maxsize=2)
def _encoder(ranks: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=load_ranks(ranks), special_tokens={}).encode_ordinary


def _encode_words(block: pa.Table, ranks_path: str, pattern: str) -> pa.Table:
    """Words of one bucket -> in their place, ids of each and how many."""
    import zstandard

    encode = _encoder(ranks_path, pattern)
    pack, unpack = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
    known: dict[bytes, bytes] = {}
    rows = []
    for r in block.to_pylist():
        words = _cut_bytes(unpack(r["words"]), unplanes(unpack(r["lengths"]), np.uint32))
        for w in words:
            if w not in known:
                known[w] = np.array(encode(w.decode()), dtype=np.uint32).tobytes()
        made = [known[w] for w in words]
        ids = np.frombuffer(b"".join(made), dtype=np.uint32)
        rows.append({"chunk": r["chunk"], "bucket": r["bucket"], "numbers": r["numbers"], 
                     "lengths": pack(planes(np.array([len(m) // 4 for m in made], dtype=np.uint32))), "words": pack(planes(ids))})
    return pa.Table.from_batches([_batch(rows)])


def _reassemble(block: pa.Table) -> pa.Table:
    """Sequences and word ids of a chunk -> ids of each document."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    rows = block.to_pylist()
    head = next((r for r in rows if r["sequence"] is not None), None)
    blocks = [r for r in rows if r["sequence"] is None]
    none = np.zeros(0, dtype=np.uint32)
    number = np.concatenate([none, *(np.cumsum(unplanes(unpack(r["numbers"]), np.uint32), dtype=np.uint32) for r in blocks)])
    lengths = np.concatenate([none, *(unplanes(unpack(r["lengths"]), np.uint32) for r in blocks)]).astype(np.int64)
    tokens = np.concatenate([none, *(unplanes(unpack(r["words"]), np.uint32) for r in blocks)])
    starts = np.cumsum(lengths) - lengths
    start, length = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64)
    start[number], length[number] = starts, lengths
    sequence = unplanes(unpack(head["sequence"]), np.uint32) if head else none
    if head is None or len(number) != (int(sequence.max()) + 1 if len(sequence) else 0):
        raise ValueError("the two passes over the documents gave different rows; write the documents first")
    counts = unplanes(head["counts"], np.uint32).astype(np.int64)
    ends = np.cumsum(counts)
    ids, totals = [], []
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        s = sequence[a:b]
        n = length[s]
        total = int(n.sum())
        places = np.repeat(start[s] - (np.cumsum(n) - n), n) + np.arange(total)
        ids.append(tokens[places].astype("<u4", copy=False).tobytes())
        totals.append(total)
    docs = [d if v else None for d, v in zip(np.frombuffer(head["docs"], dtype=np.int64).tolist(), head["valid"])]
    return pa.table({"doc_id": pa.array(docs, type=pa.int64()), "n_tokens": pa.array(totals, type=pa.int64()), "ids": pa.array(ids, type=pa.binary())})


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of docs (doc_id, text); ids are little-endian unsigned 32-bit numbers.

    Each match of pattern is encoded alone, without special tokens. Null text counts as empty and has no ids. A null doc_id stays
    null, repeated rows stay repeated. ranks is the path of the rank file on the executors.
    docs is read twice and has to give the same rows in the same order both times, as a scan of files does; if it does not,
    the job fails rather than mix them up.
    """
    prepare(docs.sparkSession)
    dealt = buckets(docs, "text", BUCKETS_PER_PARTITION)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    sequences = texts.mapInArrow(lambda it: tidy(_explode(it, pattern, None)), CHUNK)
    words = texts.mapInArrow(lambda it: tidy(_explode(it, pattern, dealt)), CHUNK).groupBy("bucket").applyInArrow(lambda t: tidied(_encode_words(t, ranks, pattern)), CHUNK)
    return sequences.union(words).groupBy("chunk").applyInArrow(lambda t: tidied(_reassemble(t)), ENCODED)


def _decode(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    table = {i: token for token, i in load_ranks(ranks).items()}
    for batch in batches:
        decoded = [b"".join(map(table.__getitem__, np.frombuffer(x or b"", dtype="<u4").tolist())) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, type=pa.binary())], names=[*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with decoded: the bytes of its column ids. Null ids give no bytes; an id outside the table is an error."""
    prepare(encoded.sparkSession)
    rest = encoded.drop("decoded")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema), "decoded binary"])
    return rest.mapInArrow(lambda it: tidy(_decode(it, ranks)), schema)


def op7_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, public_tokenizers.PATTERN)
    return decode(encoded, ranks).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


SQL: dict[str, str] = {}
