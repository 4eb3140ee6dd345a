"""Fill-in-the-middle transformation on piece tables.

A document starts as one descriptor (buffer, start, length) over its text, which never changes. Two cuts between tokens split it into
prefix, middle and suffix, and the three marks are descriptors over a second buffer. An arrangement is a permutation of these six
descriptors; its inverse brings them back. Texts are neither copied nor moved for that: an output is a list of descriptors until
somebody renders it, and hashes read the descriptors one after the other.

A token is a word with the white space before it; white space at the end is a token too. Cuts and forms follow from a hash of
the seed and doc_id, so they are the same in every run and on every machine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import prepare
from fogon.llm.words import slices, texts, tidy

SEED = 42
RATE = 50  # per cent of documents that are arranged
SPM = 80  # per cent of those that begin with the suffix
MARKS = "<P><S><M>"
MARK = 3  # length of each
TEXT_BUFFER, MARK_BUFFER = 0, 1
# Descriptors of a cut document, in this order: marks of prefix, suffix and middle, then prefix, middle and suffix themselves.
ARRANGED = {"psm": np.array([0, 3, 1, 5, 2, 4]), "spm": np.array([1, 5, 0, 3, 2, 4])}
PIECES = "array<struct<buffer:int,start:bigint,length:bigint>>"
ADDED = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "pieces": PIECES}


def _draws(seed: int) -> F.Column:
    """Four numbers of 32 bits for each document."""
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(hexes, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def split(length: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Piece tables (documents, 6, 3): the marks, and the text's descriptor cut at two places."""
    out = np.zeros((len(length), 6, 3), dtype=np.int64)
    out[:, :3] = [[MARK_BUFFER, MARK * i, MARK] for i in range(3)]
    out[:, 4, 1], out[:, 5, 1] = first, second
    out[:, 3, 2], out[:, 4, 2], out[:, 5, 2] = first, second - first, length - second
    return out


def _arranged(batches: Iterator[pa.RecordBatch], rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    """The columns without draws, then those of ADDED."""
    marks = [MARKS[i : i + MARK].encode() for i in range(0, len(MARKS), MARK)]
    for batch in batches:
        draws = batch.column("_draws").flatten().to_numpy().reshape(-1, 4)
        offsets, _ = texts(batch.column("text"))
        length = np.diff(offsets)
        n, first, second, prefix, middle = (np.zeros(len(length), dtype=np.int64) for _ in range(5))
        marked = np.zeros(len(length), dtype=bool)
        for w in slices(batch.column("text")):
            own = slice(w.first, w.first + w.docs)
            words = w.counts()
            before = np.cumsum(words) - words
            begin, end = w.bounds[:-1], w.bounds[1:]
            stops = np.r_[0, w.ends]
            last = np.where(words > 0, stops[before + words], begin)
            units = words + (last < end)
            n[own] = units

            def place(unit: np.ndarray) -> np.ndarray:
                return np.where(unit == 0, begin, np.where(unit <= words, stops[before + np.minimum(unit, words)], end))

            cuts = np.sort(draws[own, :2] % (units + 1)[:, None], axis=1)
            a, b = place(cuts[:, 0]), place(cuts[:, 1])
            chars = np.r_[0, np.cumsum((w.data & 0xC0) != 0x80)]
            first[own], second[own] = a - begin, b - begin
            prefix[own], middle[own] = chars[a] - chars[begin], chars[b] - chars[a]
            raw = w.data.tobytes()
            if any(m in raw for m in marks):
                marked[own] = [any(raw.find(m, x, y) >= 0 for m in marks) for x, y in zip(begin.tolist(), end.tolist())]
        plain = (length == 0) | marked | (draws[:, 2] % 100 >= rate)
        suffix_first = ~plain & (draws[:, 3] % 100 < spm)
        tables = split(length, first, second)
        for form, rows in (("psm", ~plain & ~suffix_first), ("spm", suffix_first)):
            tables[rows] = tables[rows][:, ARRANGED[form]]
        tables[plain, 0] = np.stack([np.full(plain.sum(), TEXT_BUFFER), np.zeros(plain.sum(), dtype=np.int64), length[plain]], axis=1)
        size = np.where(plain, 1, 6)
        flat = tables[np.arange(6)[None, :] < size[:, None]]
        structs = pa.StructArray.from_arrays([pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1]), pa.array(flat[:, 2])], names=["buffer", "start", "length"])
        forms = np.where(plain, "plain", np.where(suffix_first, "spm", "psm"))
        added = [pa.array(n), pa.array(forms.tolist(), type=pa.string()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain),
                 pa.ListArray.from_arrays(np.r_[0, np.cumsum(size)].astype(np.int32), structs)]
        kept = [i for i, c in enumerate(batch.schema.names) if c != "_draws"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *added], names=[*(batch.schema.names[i] for i in kept), *ADDED])


def _schema(docs: DataFrame, added: dict[str, str]) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"`{c}` {kind}" for c, kind in added.items())])


def arrange(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` with n (tokens), form (plain, psm or spm), prefix_chars, middle_chars (code points, null if plain) and pieces.

    pieces is the output's piece table in bytes of UTF-8: buffer 0 is the text, buffer 1 is MARKS. Null text counts as empty and stays
    null. Empty texts and texts that hold a mark are plain. A null doc_id is written as nothing where it is hashed. Rows
    of one doc_id are arranged alike if their texts are. Columns named like the added ones are replaced.
    """
    prepare(docs.sparkSession)
    rest = docs.drop(*ADDED, "_draws")
    return rest.withColumn("_draws", _draws(seed)).mapInArrow(lambda it: tidy(_arranged(it, rate, spm)), _schema(rest, ADDED))


def _views(batch: pa.RecordBatch) -> Iterator[list[memoryview]]:
    """The parts of each row's output, in order, as views of the buffers."""
    offsets, data = texts(batch.column("text"))
    pieces = batch.column("pieces")
    flat = pieces.flatten()
    buffer, start, length = (flat.field(i).to_numpy().tolist() for i in range(3))
    ends = np.cumsum(np.diff(pieces.offsets.to_numpy())).tolist()
    sources = [memoryview(data), memoryview(MARKS.encode())]
    at = 0
    for row, end in enumerate(ends):
        base = [int(offsets[row]), 0]
        yield [sources[buffer[i]][base[buffer[i]] + start[i] : base[buffer[i]] + start[i] + length[i]] for i in range(at, end)]
        at = end


def inverse(output: bytes, form: str) -> list[memoryview]:
    """Parts of the original text, in order: the output's descriptor is cut at its marks, and the permutation undone."""
    whole = memoryview(output)
    if form == "plain":
        return [whole]
    order = ARRANGED[form]
    at = [output.index(MARKS[MARK * m : MARK * m + MARK].encode()) for m in order[::2]]
    pieces = [p for a, b in zip(at, [*at[1:], len(output)]) for p in (whole[a : a + MARK], whole[a + MARK : b])]
    return [pieces[i] for i in np.argsort(order)[3:]]


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        output = [b"".join(parts) for parts in _views(batch)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(output, type=pa.binary()).cast(pa.string())], names=[*batch.schema.names, "output"])


def render(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the column output: the text that its pieces describe."""
    rest = arranged.drop("output")
    return rest.mapInArrow(lambda it: tidy(_rendered(it)), _schema(rest, {"output": "string"}))


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = texts(batch.column("output"))
        forms = batch.column("form").to_pylist()
        rows = [b"".join(inverse(data[offsets[i] : offsets[i + 1]].tobytes(), f or "plain")) for i, f in enumerate(forms)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, type=pa.binary()).cast(pa.string())], names=[*batch.schema.names, "restored"])


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (output, form) with the column restored: the text before it was arranged. A null form counts as plain."""
    prepare(outputs.sparkSession)
    rest = outputs.drop("restored")
    return rest.mapInArrow(lambda it: tidy(_restored(it)), _schema(rest, {"restored": "string"}))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digest(parts: list[memoryview]) -> str:
        h = hashlib.sha256()
        for p in parts:
            h.update(p)
        return h.hexdigest()

    for batch in batches:
        forms = batch.column("form").to_pylist()
        out, back = [], []
        for parts, form in zip(_views(batch), forms):
            out.append(digest(parts))
            back.append(digest(inverse(b"".join(parts), form)))
        kept = [i for i, c in enumerate(batch.schema.names) if c not in ("text", "pieces")]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(out, type=pa.string()), pa.array(back, type=pa.string())],
                                         names=[*(batch.schema.names[i] for i in kept), "output_sha256", "restored_sha256"])


def digests(arranged: DataFrame) -> DataFrame:
    """``arranged`` with SHA-256 of the output and of the text rebuilt from output and form, instead of text and pieces."""
    rest = arranged.drop("output_sha256", "restored_sha256")
    return rest.mapInArrow(lambda it: tidy(_hashed(it)), _schema(rest.drop("text", "pieces"), {"output_sha256": "string", "restored_sha256": "string"}))


def op13_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(arrange(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


SQL = {
    "op13_piece_table": r"""
with t as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, '')) as s from documents),
h as (
  select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
    list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(s, i, 8))::bigint) as h from t),
c as (
  select *, len(u) as n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as lo, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as hi,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 50 then 'plain'
      when h[4] % 100 < 80 then 'spm' else 'psm' end as form from h),
p as (
  select *, array_to_string(u[1:lo], '') as a, array_to_string(u[lo + 1:hi], '') as b, array_to_string(u[hi + 1:], '') as z from c),
o as (
  select *, case form when 'plain' then t when 'psm' then '<P>' || a || '<S>' || z || '<M>' || b else '<S>' || z || '<P>' || a || '<M>' || b end as out from p),
q as (select *, strpos(out, '<P>') as pa, strpos(out, '<S>') as sa, strpos(out, '<M>') as ma from o)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(a) end::bigint as prefix_chars,
  case when form <> 'plain' then length(b) end::bigint as middle_chars, sha256(out) as output_sha256,
  sha256(case form when 'plain' then out
    when 'psm' then substr(out, pa + 3, sa - pa - 3) || substr(out, ma + 3) || substr(out, sa + 3, ma - sa - 3)
    else substr(out, pa + 3, ma - pa - 3) || substr(out, ma + 3) || substr(out, sa + 3, pa - sa - 3) end) as restored_sha256
from q"""
}
