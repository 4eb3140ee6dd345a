"""Spelling variants of corpus words by a bit-sliced position index.

Two words are near if one inserted, deleted or replaced letter makes one of the other. Of such a pair, either the first half or
the rest is untouched, so the words meet in a cell named by that half (for words of one length and of the next). Cells of one word
drop out; the others share blocks, and a cell of very many words is cut into parts, each pair of which is a block.

A block slices its words by position: for each (position, letter) a bitset tells which words have the letter there. All
words of the block are then read letter by letter against all of them at once, in machine words of 64 candidates. Four sets are kept while
reading: those that agree so far (no error), and those with one error so far, by what it was. An extra or a missing letter shifts
the position of the slice that the next letter is looked up in. A pair is counted in one place only, and a block returns sums and the best neighbour
of each word, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import cut, prepare
from fogon.llm.words import release

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5  # how much more frequent a form is
SLIP = 199  # one run in so many loses a letter
LETTERS = 32_768  # of the words of a block, or of a part of a cell


def occurrences(docs: DataFrame) -> DataFrame:
    """(word): every run of letters, lower-cased (A-Z only), of which every 199th by hash has lost a letter."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    lowered = run.select("d", F.translate("run", UPPER, LOWER).alias("w"))
    hashed = lowered.select("w", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("w")).cast("int")
    shorter = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    return hashed.select(F.when(F.col("h") % SLIP == 0, shorter).otherwise(F.col("w")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return words.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _entries(words: DataFrame) -> DataFrame:
    """A row for each cell a word belongs to: (word, n, least, side, first, cell).

    least is the length of the shorter word of a pair. Side 0 names the first half of it, side 1 the rest; first names
    the first half in both, so that a pair that agrees in both halves is told apart.
    """
    def cell(least: Column, side: int) -> Column:
        half = F.floor(least / 2).cast("int")
        head = F.substring("word", F.lit(1), half)
        tail = F.substring("word", F.length("word") - (least - half) + 1, least - half)
        first = F.xxhash64(least, F.lit(0), head)
        return F.struct(least.alias("least"), F.lit(side).alias("side"), first.alias("first"),
                        (F.xxhash64(least, F.lit(1), tail) if side else first).alias("cell"))

    length = F.length("word")
    return words.select("word", "n", F.inline(F.array(*[cell(m, side) for m in (length, length - 1) for side in (0, 1)])))


def _slices(codes: np.ndarray, letters: int, position: int) -> np.ndarray:
    """Bitsets (letter, machine word) of the words that have the letter at the position; the last row is of words that end before."""
    words = len(codes)
    has = np.zeros((letters + 1, -(-words // 64) * 64), dtype=bool)
    if 0 <= position < codes.shape[1]:
        has[codes[:, position], np.arange(words)] = True
    return np.packbits(has, axis=1, bitorder="little").view(np.uint64)


def one_error(codes: np.ndarray, lengths: np.ndarray, letters: int) -> np.ndarray:
    """Bitsets (word, machine word): the words that exactly one inserted, deleted or replaced letter makes of each word.

    codes (word, position) are letters 0 .. letters - 1, and ``letters`` beyond a word's end.
    """
    words = len(codes)
    wide = -(-words // 64)

    def bits(mask: np.ndarray) -> np.ndarray:
        full = np.zeros(wide * 64, dtype=bool)
        full[: len(mask)] = mask
        return np.packbits(full, bitorder="little").view(np.uint64)

    out = np.zeros((words, wide), dtype=np.uint64)
    none = np.zeros((letters + 1, wide), dtype=np.uint64)
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        agree = np.tile(bits(np.ones(words, dtype=bool)), (len(own), 1))
        replaced, longer, shorter = (np.zeros_like(agree) for _ in range(3))
        before, here, after = none, _slices(codes, letters, 0), _slices(codes, letters, 1)
        for i in range(length):
            letter = codes[own, i]
            same = here[letter]
            longer = (longer | agree) & after[letter]  # the other word has one letter more: look one place ahead
            shorter = (shorter & before[letter]) | agree  # it lacks one: this letter has no partner
            replaced = (replaced & same) | (agree & ~same)
            agree = agree & same
            before, here, after = here, after, _slices(codes, letters, i + 2)
        out[own] = (replaced & bits(lengths == length)) | ((longer | agree) & bits(lengths == length + 1)) | (shorter & bits(lengths == length - 1))
    return out


def _pairs(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members (row, column) of bitsets."""
    row, at = np.nonzero(sets)
    inner = np.unpackbits(np.ascontiguousarray(sets[row, at])[:, None].view(np.uint8), axis=1, bitorder="little")
    which, bit = np.nonzero(inner)
    return row[which], at[which] * 64 + bit


def _near(block: pa.Table) -> pa.Table:
    """(word, n_near, best_n, best) of the entries of a block, for entries with any neighbour that is counted here."""
    words = block.column("word").to_pylist()
    n, least, side, first, cell, part, low, high = (block.column(c).to_numpy() for c in ("n", "least", "side", "first", "cell", "part", "low", "high"))
    out: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
    for m in np.unique(least):
        rows = np.flatnonzero(least == m)
        raw = [np.frombuffer(words[i].encode("utf-32-le"), dtype=np.uint32) for i in rows]
        lengths = np.array([len(x) for x in raw])
        used, flat = np.unique(np.concatenate(raw), return_inverse=True)
        codes = np.full((len(rows), int(m) + 1), len(used), dtype=np.int32)
        codes[np.arange(int(m) + 1)[None, :] < lengths[:, None]] = flat
        a, b = _pairs(one_error(codes, lengths, len(used)))
        x, y = rows[a], rows[b]
        # Words meet in a block by chance too: a pair counts in the cell of its first half, or of the rest if the first halves differ.
        own = (cell[x] == cell[y]) & ((side[x] == 0) | (first[x] != first[y])) & ((low[x] == high[x]) | (part[x] != part[y]))
        # Of words of one length, or of neighbouring ones: a pair of two words of m + 1 letters counts where least is m + 1.
        own &= (lengths[a] == m) | (lengths[b] == m)
        a, b = a[own], b[own]
        if not len(a):
            continue
        order = sorted(range(len(rows)), key=lambda i: (-n[rows[i]], words[rows[i]]))
        rank = np.empty(len(rows), dtype=np.int64)
        rank[order] = np.arange(len(rows))
        count = np.bincount(a, minlength=len(rows))
        best = np.full(len(rows), len(rows), dtype=np.int64)
        np.minimum.at(best, a, rank[b])
        for i in np.flatnonzero(count).tolist():
            top = rows[order[best[i]]]
            out["word"].append(words[rows[i]])
            out["n_near"].append(int(count[i]))
            out["best_n"].append(int(n[top]))
            out["best"].append(words[top])
    release()
    return pa.table({"word": pa.array(out["word"], pa.string()), "n_near": pa.array(out["n_near"], pa.int64()),
                     "best_n": pa.array(out["best_n"], pa.int64()), "best": pa.array(out["best"], pa.string())})


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for the words (word, n; distinct) that have a near word; best is the most frequent, then the smallest.

    Words of fewer than two letters have no halves and take no part; a null word neither.
    """
    spark = prepare(words.sparkSession)
    entries = cut(_entries(words.filter(F.length("word") >= 2)), "spelling-cells")
    crowd = entries.groupBy("cell").agg(F.count("*").alias("size"), F.sum(F.length("word")).alias("letters")).filter("size > 1")
    dealt = cut(entries.join(crowd.select("cell", F.ceil(F.col("letters") / LETTERS).cast("long").alias("parts")), "cell"), "spelling-entries")
    blocks = 1 + (dealt.agg(F.sum(F.length("word"))).first()[0] or 0) // LETTERS
    placed = dealt.withColumn("part", F.pmod(F.xxhash64("word", F.lit(5)), F.col("parts"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    placed = placed.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    key = F.when(F.col("parts") == 1, F.pmod("cell", F.lit(blocks)).cast("string")).otherwise(F.concat_ws(":", "cell", "low", "high"))
    found = placed.withColumn("block", key).select("block", "word", "n", "least", "side", "first", "cell", "part", "low", "high").groupBy("block").applyInArrow(
        _near, "word string, n_near long, best_n long, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("b"))
    return summed.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for forms (word, form): the last word of each chain of forms.

    Counts grow at least fivefold along a chain, so chains are short; each round doubles what a row has skipped.
    """
    links = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = links.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        step = cut(links.join(on, links.root == on.via, "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        links = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return links


def spelling_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every frequent word of ``docs`` (doc_id, text).

    A word's form is its most frequent near word if that is at least five times as frequent, else null. Null, empty
    and letterless texts have no words; a null doc_id is written as nothing where it is hashed; repeated rows count as often as they occur.
    Other columns are ignored.
    """
    prepare(docs.sparkSession)
    words = cut(vocabulary(occurrences(docs.select("doc_id", "text"))), "spelling-words")
    near = words.join(neighbours(words), "word", "left")
    fits = F.col("best_n") >= RATIO * F.col("n")
    named = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")), "spelling-forms")
    last = roots(named.filter("form is not null"))
    return named.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The CRC is linear: each byte contributes a value by its distance from the end, and the values are added without carry.
SQL = {
    "op11_bit_sliced": r"""
with recursive run as (
  select doc_id, w, count(*) as times from (
    select doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+'),
      lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) as w from documents) group by 1, 2),
byte as (
  select doc_id, w, hex(encode(coalesce(doc_id::varchar, '') || ':' || w)) as x from run),
place as (
  select doc_id, w, length(x) // 2 as len, unnest(range(0, length(x) // 2)) as p, x from byte),
bits(v, k, c) as (
  select v::bigint, 0, v::bigint from range(256) r(v)
  union all
  select v, k + 1, case when c % 2 = 1 then xor(3988292384, c >> 1) else c >> 1 end from bits where k < 8),
tab as (select v, c from bits where k = 8),
far(v, d, c) as (
  select v, 0, c from tab
  union all
  select far.v, d + 1, xor(far.c >> 8, tab.c) from far join tab on tab.v = far.c & 255 where d < (select max(len) from place)),
nought(d, c) as (
  select 0, 4294967295
  union all
  select d + 1, xor(nought.c >> 8, tab.c) from nought join tab on tab.v = nought.c & 255 where d < (select max(len) from place)),
crc as (
  select place.doc_id, place.w, xor(xor(bit_xor(far.c), any_value(nought.c)), 4294967295) as h
  from place join far on far.v = ('0x' || substr(x, 2 * p + 1, 2))::bigint and far.d = len - p - 1 join nought on nought.d = len
  group by place.doc_id, place.w),
word as (
  select case when h % 199 = 0 then substr(run.w, 1, h % length(run.w)) || substr(run.w, h % length(run.w) + 2) else run.w end as word, times
  from run join crc on run.doc_id is not distinct from crc.doc_id and run.w = crc.w),
vocab as (
  select word, sum(times)::bigint as n from word where length(word) >= 6 group by word having sum(times) >= 5),
less as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as d from (select word, n, unnest(range(1, length(word) + 1)) as i from vocab)),
near as (
  select a.word, b.word as other, b.n as m from less a join less b on a.d = b.d and a.i = b.i and a.word <> b.word
  union
  select less.word, vocab.word, vocab.n from less join vocab on less.d = vocab.word
  union
  select vocab.word, less.word, less.n from less join vocab on less.d = vocab.word),
best as (select word, count(*) as n_near, max(m) as form_n, arg_min(other, (-m, other)) as form from near group by word),
named as (
  select word, n, coalesce(n_near, 0)::bigint as n_near, case when form_n >= 5 * n then form end as form, case when form_n >= 5 * n then form_n end as form_n
  from vocab left join best using (word)),
chain(word, last, form) as (
  select word, word, form from named
  union all
  select chain.word, named.word, named.form from chain join named on named.word = chain.form)
select named.word, named.form, last as root, n, n_near, form_n from named join chain on chain.word = named.word and chain.form is null"""
}
