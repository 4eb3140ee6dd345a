"""Packing along a space-filling curve.

Each document's hashed word vector (log term weights, unit length) is projected to a few dimensions with fixed random
signs, each coordinate becomes a grid number, and the Hilbert key of the grid point orders the documents. The rows are
range-partitioned by that key, sorted, tokenized and packed one after the other, so neighbours along the curve share
sequences. Documents are cut where a sequence is full. What a partition has left at its end is cut into
sequences of descending powers of two, so nothing is padded at all.

The text is shuffled once. Tokens never are: a partition packs its own sequences.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import buckets, prepare
from fogon.llm.words import mix, slices, tidy

LENGTH = 2048
END = 1
DIMENSIONS = 6
BITS = 10
VECTOR = 4096  # hashed vector's length
# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of whole-number points (rows), coordinates below 2^bits, by the transposed Gray-code method."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:
        p, bit = np.uint64(q - 1), np.uint64(q)
        for i in range(n):
            high = (x[i] & bit) > 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & np.uint64(q)) > 0, t ^ np.uint64(q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def curve_keys(w, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Hilbert key of each document of a slice of words; documents without words lie at the middle of the grid."""
    hashes = w.hashes(lower=True)
    kind = np.uint32 if w.docs < (1 << 32) // VECTOR else np.uint64
    cell = np.sort(w.doc.astype(kind) * kind(VECTOR) + (hashes & np.uint64(VECTOR - 1)).astype(kind))
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.r_[first, len(cell)])
    cell = cell[first]
    doc, slot = (cell // kind(VECTOR)).astype(np.int64), cell % kind(VECTOR)
    weight = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, weights=weight**2, minlength=w.docs))
    sides = mix(slot, 77)
    points = np.empty((w.docs, dimensions))
    for i in range(dimensions):
        sign = np.where((sides >> np.uint64(i)) & np.uint64(1) > 0, 1.0, -1.0)
        points[:, i] = np.bincount(doc, weights=weight * sign, minlength=w.docs)
    points /= np.where(norm > 0, norm, 1)[:, None]
    grid = np.tanh(points / 2) * 0.5 + 0.5  # logistic: near-even use of the grid for sums of many random signs
    return hilbert(np.minimum((grid * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [curve_keys(w) for w in slices(batch.column(1))]
        if keys:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(keys))], names=["doc_id", "text", "curve"])


def ranks_of(path: str) -> tuple[dict[bytes, int], list[str]]:
    """Byte strings and ids of a byte-level BPE file, and the added tokens.

    Raises ValueError unless ids follow the order of the merges, as in that order a rank encoder merges.
    """
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = [t["content"] for t in made["added_tokens"]]
    vocabulary = {t: i for t, i in made["model"]["vocab"].items() if t not in added}
    ranks = {bytes(of[c] for c in t): i for t, i in vocabulary.items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
    order = [vocabulary[a + b] for a, b in merges]
    if order != sorted(order):
        raise ValueError(f"{path}: ids don't follow the merges")
    return ranks, added


class Tokens:
    """Token ids of whole texts as unsigned 32-bit numbers.

    The file's merges run in a rank encoder, which is several times faster than the file's own library and gives the same
    ids; a text that holds an added token's name goes to that library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        ranks, self.added = ranks_of(path)
        self.library = Tokenizer.from_file(path)
        self.encoder = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.encoder.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def powers_of_two(n: int) -> list[int]:
    """n as a sum of descending powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, end: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents of one partition in their order."""
    tokens = _tokens(path)
    base, sequence = TaskContext.get().partitionId() << 40, 0
    open_pieces: list[tuple] = []  # of the sequence being filled: doc_id, start, ids, doc_tokens
    filled = 0
    names = [x.split()[0] for x in PIECE.split(", ")]
    done: list[tuple] = []

    def close(pieces: list[tuple], size: int) -> None:
        nonlocal sequence
        at = 0
        for doc, start, ids, total in pieces:
            done.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False)), total, base | sequence, at, size))
            at += len(ids)
        sequence += 1

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*done)], names=names)
        done.clear()
        return batch

    last = np.array([end], dtype=np.uint32)
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.concatenate([tokens(text.as_py() or ""), last])
            at = 0
            while at < len(ids):
                n = min(len(ids) - at, length - filled)
                open_pieces.append((doc, at, ids[at : at + n], len(ids)))
                at += n
                filled += n
                if filled == length:
                    close(open_pieces, length)
                    open_pieces, filled = [], 0
        if done:
            yield flush()
    for size in powers_of_two(filled):
        taken, room = [], size
        while room:
            doc, start, ids, total = open_pieces.pop(0)
            taken.append((doc, start, ids[:room], total))
            if len(ids) > room:
                open_pieces.insert(0, (doc, start + room, ids[room:], total))
            room -= len(taken[-1][2])
        close(taken, size)
    if done:
        yield flush()


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece of a document in a sequence.

    doc_id, start (ids of the document before the piece), length, ids_crc32, doc_tokens, sequence_id, offset (in the sequence) and
    sequence_length (``length`` or, at a partition's end, a power of two). Null text counts as empty: its end id alone.
    A null doc_id is kept as null; repeated rows are packed as often as they occur. tokenizer is the path of the vocabulary
    on the executors.
    """
    prepare(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: tidy(_with_keys(it)), "doc_id long, text string, curve long")
    # doc_id spreads documents of one key, such as copies, over several ranges.
    ranges = buckets(docs, "text", 1)
    ranged = keyed.repartitionByRange(ranges, "curve", "doc_id").sortWithinPartitions("curve", "doc_id", F.xxhash64("text"))
    return ranged.select("doc_id", "text").mapInArrow(lambda it: tidy(_pack(it, tokenizer, length, end)), PIECE)


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


SQL: dict[str, str] = {}
