"""Line dedup by overlapping three-line windows.

Every three consecutive lines are hashed (128 bits). A window that occurs in a document with a smaller id, or earlier in its
own document, is a later occurrence; the lines that such windows cover are merged and removed. Windows without a word, such
as runs of empty lines, don't count. A window's first document is found by an aggregation that combines before the shuffle, so a
window of a third of all documents costs a row per task; the join back is an inner one that adaptive execution can split.
What is removed belongs to a row's doc_id and text (64 bits of hash), so rows that share a doc_id don't lose each other's lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import prepare
from fogon.llm.words import BYTES, BYTE_SYMBOLS, SPACES, WORDS, Powers, mix, texts, tidy

LINES = 3
OTHER = Powers(0xE7037ED1A0B428DB)
SLICE = 1 << 20


def line_table(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, begin and end of each \\n-split line; a document has one line more than breaks."""
    breaks = np.flatnonzero(data == 10)
    docs = len(bounds) - 1
    begin = np.r_[bounds[:-1], breaks + 1]
    owner = np.r_[np.arange(docs), np.searchsorted(bounds, breaks, side="right") - 1]
    order = np.lexsort((begin, owner))
    begin, owner = begin[order], owner[order]
    last = np.r_[owner[1:] != owner[:-1], True] if docs else np.zeros(0, dtype=bool)
    end = np.where(last, bounds[owner + 1], np.r_[begin[1:] - 1, 0][: len(begin)]) if docs else begin
    return owner, begin, end


def _windows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text, print -> h1, h2, doc_id, print, line (of the first), again (the same window starts earlier in the document)."""
    for batch in batches:
        ids, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        offsets, raw = texts(batch.column(1))
        at = 0
        while at < len(offsets) - 1:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
            data, bounds = raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            doc, begin, end = line_table(data, bounds)
            first = np.arange(max(0, len(doc) - k + 1))
            first = first[doc[: len(first)] == doc[k - 1 :]] if len(first) else first
            words = np.r_[0, np.cumsum(~SPACES[data])]
            first = first[words[end[first + k - 1]] > words[begin[first]]]
            if len(first):
                symbols = BYTE_SYMBOLS[data]
                h1 = mix(WORDS.ranges(mix(BYTES.ranges(symbols, begin, end), 21), first, first + k), 1).view(np.int64)
                h2 = mix(WORDS.ranges(mix(OTHER.ranges(symbols, begin, end), 22), first, first + k), 2).view(np.int64)
                owner = doc[first]
                place = first - np.searchsorted(doc, owner, side="left")
                order = np.lexsort((place, h2, h1, owner))
                again = np.zeros(len(first), dtype=bool)
                a, b = order[1:], order[:-1]
                again[a] = (owner[a] == owner[b]) & (h1[a] == h1[b]) & (h2[a] == h2[b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), pa.array(ids[at + owner]), pa.array(prints[at + owner]), pa.array(place.astype(np.int32)), pa.array(again)],
                    names=["h1", "h2", "doc_id", "print", "line", "again"])
            at = to


def later_windows(docs: DataFrame, k: int = LINES) -> DataFrame:
    """(doc_id, print, lines): first lines of the windows that are later occurrences, one row for each doc_id and text with any."""
    windows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print")).mapInArrow(
        lambda it: tidy(_windows(it, k)), "h1 long, h2 long, doc_id long, print long, line int, again boolean")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    elsewhere = windows.filter("not again").join(least, ["h1", "h2"]).filter("doc_id > least").select("doc_id", "print", "line")
    # A window that occurs again in its document is later there wherever else it occurs.
    return elsewhere.union(windows.filter("again").select("doc_id", "print", "line")).groupBy("doc_id", "print").agg(F.collect_set("line").alias("lines"))


def _cut(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Replaces the text, and the list of windows by the numbers of lines and of removed ones."""
    for batch in batches:
        text, n_lines, n_removed = [], [], []
        for t, firsts in zip(batch.column("text").to_pylist(), batch.column("lines").to_pylist()):
            lines = (t or "").split("\n")
            n_lines.append(len(lines))
            if not firsts:
                text.append(t)
                n_removed.append(0)
                continue
            covered = np.zeros(len(lines) + 1, dtype=np.int64)
            at = np.unique(firsts)
            covered[at] += 1
            covered[at + k] -= 1
            gone = np.cumsum(covered)[:-1] > 0
            text.append("\n".join([x for x, g in zip(lines, gone.tolist()) if not g]))
            n_removed.append(int(gone.sum()))
        arrays = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "lines"}
        arrays |= {"text": pa.array(text, type=pa.string()), "n_lines": pa.array(n_lines, type=pa.int64()), "n_removed": pa.array(n_removed, type=pa.int64())}
        yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def dedup_lines(docs: DataFrame, k: int = LINES) -> DataFrame:
    """``docs`` with lines removed from text, and the columns n_lines and n_removed; n_chars, where it exists, follows the text.

    Documents of fewer than three lines keep them. Null text stays null and counts as one line. Rows of one doc_id are one
    document as regards which occurrence comes first; each loses the lines of its own text only. A null doc_id is left as it is. Columns named like the added ones are replaced.
    """
    prepare(docs.sparkSession)
    rest = docs.drop("n_lines", "n_removed", "lines")
    later = later_windows(docs, k).withColumnsRenamed({"doc_id": "_doc", "print": "_print"})
    joined = rest.join(later, (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_print")), "left").drop("_doc", "_print")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema), "n_lines long, n_removed long"])
    out = joined.mapInArrow(lambda it: tidy(_cut(it, k)), schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(rest.schema["n_chars"].dataType))
    return out


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


SQL = {
    "op6_line_windows": r"""
with l as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as ls from documents),
win as (
  select doc_id, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] as g
  from (select doc_id, ls, unnest(range(1, len(ls) - 1)) as i from l)),
hit as (
  select doc_id, i from win where regexp_matches(g, '[^\x20\x09-\x0D]')
  qualify row_number() over (partition by g order by doc_id, i) > 1),
cov as (select distinct doc_id, unnest(range(i, i + 3)) as p from hit),
pos as (select doc_id, ls[p] as line, p from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as p from l)),
kept as (select doc_id, string_agg(line, chr(10) order by p) as t, count(*) as n from pos anti join cov using (doc_id, p) group by doc_id)
select l.doc_id, len(ls)::bigint as n_lines, (len(ls) - coalesce(n, 0))::bigint as n_removed,
  case when text is null then null else coalesce(t, '') end as text
from l left join kept using (doc_id)"""
}
