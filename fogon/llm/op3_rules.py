"""Quality rules as a learned decision list.

Statistics of every whole text are computed in one pass. A bounded sample of labelled rows trains an ordered list of
rules by sequential covering: a rule is a conjunction of thresholds, grown on one part of the rows by information gain and
pruned on the other; rows it covers are taken away and the next rule is learned from the rest. The list becomes one ordered
Spark conditional expression, so that applying it is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import cut, prepare
from fogon.llm.words import BYTES, BYTE_SYMBOLS, slices, tidy

REPEAT_WINDOW = 8
SAMPLE = 20_000
MIN_COVER = 8
MIN_PRECISION = 0.75
MAX_CONDITIONS = 4
THRESHOLDS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_lower", "n_digits", "n_exclaim", "n_commas"]
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def features() -> dict[str, Column]:
    """Ratios that rules are made of."""
    def per(a: str, b: Column) -> Column:
        return F.col(a) / F.greatest(b, F.lit(1))

    words, lines = F.col("n_words"), F.col("n_lines")
    return {
        "n_words": words.cast("double"), "mean_word": per("word_chars", words), "symbols": per("n_symbols", words),
        "dup_lines": per("n_dup_lines", lines), "repeats": per("n_repeat_words", words), "distinct": per("n_distinct", words),
        "upper": per("n_upper", F.col("n_upper") + F.col("n_lower")), "digits": per("n_digits", F.col("word_chars")),
        "exclaim": per("n_exclaim", words), "commas": per("n_commas", words), "line_words": per("n_words", lines),
    }


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


SYMBOLS, DIGITS, EXCLAIM, COMMAS = _table(b"#*$%&|<>"), _table(b"0123456789"), _table(b"!"), _table(b",;")
UPPER, LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))


def text_stats(w) -> dict[str, np.ndarray]:
    """Counts of each document of a slice of words."""
    def per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask)]
        return total[w.bounds[1:]] - total[w.bounds[:-1]]

    inside = np.zeros(len(w.data) + 1, dtype=np.int8)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    inside = np.cumsum(inside)[:-1] > 0
    n = w.counts()
    hashes = w.hashes()

    first, win = w.windows(hashes, REPEAT_WINDOW)
    order = np.lexsort((win, w.doc[first])) if len(first) else first
    d, h = w.doc[first][order], win[order]
    same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    again = np.zeros(len(first), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(w.starts) + 1, dtype=np.int64)
    np.add.at(cover, first[again], 1)
    np.add.at(cover, first[again] + REPEAT_WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0

    o = np.lexsort((hashes, w.doc))
    fresh = np.r_[True, (w.doc[o][1:] != w.doc[o][:-1]) | (hashes[o][1:] != hashes[o][:-1])] if len(o) else np.zeros(0, dtype=bool)

    breaks = np.flatnonzero(w.data == 10)
    begin = np.sort(np.r_[w.bounds[:-1], breaks + 1])
    owner = np.sort(np.r_[np.arange(w.docs), np.searchsorted(w.bounds, breaks, side="right") - 1])
    end = np.r_[begin[1:] - 1, len(w.data)] if len(begin) else begin
    last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, dtype=bool)
    end = np.where(last, w.bounds[owner + 1], end)
    worded = np.r_[0, np.cumsum(inside)]
    full = worded[end] > worded[begin]
    lines = BYTES.ranges(BYTE_SYMBOLS[w.data], begin[full], end[full])
    lo = np.lexsort((lines, owner[full]))
    ld, lh = owner[full][lo], lines[lo]
    dup = np.r_[False, (ld[1:] == ld[:-1]) & (lh[1:] == lh[:-1])] if len(lo) else np.zeros(0, dtype=bool)

    return {
        "n_words": n, "word_chars": per_doc(inside & ((w.data & 0xC0) != 0x80)), "n_symbols": per_doc(SYMBOLS[w.data]),
        "n_dup_lines": np.bincount(ld[dup], minlength=w.docs), "n_repeat_words": np.bincount(w.doc[covered], minlength=w.docs),
        "n_lines": np.bincount(owner, minlength=w.docs), "n_distinct": np.bincount(w.doc[o][fresh], minlength=w.docs),
        "n_upper": per_doc(UPPER[w.data]), "n_lower": per_doc(LOWER[w.data]), "n_digits": per_doc(DIGITS[w.data]),
        "n_exclaim": per_doc(EXCLAIM[w.data]), "n_commas": per_doc(COMMAS[w.data]),
    }


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in slices(batch.column(1)):
            made = text_stats(w)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.first, w.docs), *(pa.array(made[c].astype(np.int64)) for c in COUNTS)], names=["doc_id", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row of docs(doc_id, text). Null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: tidy(_stats(it)), STATS)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        c = of[self.feature]
        return c >= F.lit(self.threshold) if self.at_least else c <= F.lit(self.threshold)

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] <= self.threshold


def _mask(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.mask(x)
    return out


def _grow(x: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    """Add the condition of highest information gain until the rule covers low-quality rows only."""
    rule: list[Condition] = []
    inside = np.ones(len(low), dtype=bool)
    while len(rule) < MAX_CONDITIONS:
        p, n = (inside & low).sum(), (inside & ~low).sum()
        if not p or not n:
            break
        best, chosen = 0.0, None
        for name, values in x.items():
            v = values[inside]
            o = np.argsort(v, kind="stable")
            v, positive = v[o], low[inside][o]
            cum = np.r_[0, np.cumsum(positive)]
            for t in np.unique(np.quantile(v[positive], np.linspace(0, 1, THRESHOLDS), method="nearest")):
                for at_least in (True, False):
                    i = np.searchsorted(v, t, side="left" if at_least else "right")
                    p1 = cum[-1] - cum[i] if at_least else cum[i]
                    all1 = len(v) - i if at_least else i
                    if p1 < MIN_COVER or all1 == len(v):
                        continue
                    gain = p1 * (np.log2(p1 / all1) - np.log2(p / (p + n)))
                    if gain > best + 1e-9:
                        best, chosen = gain, Condition(name, at_least, float(t))
        if chosen is None:
            break
        rule.append(chosen)
        inside &= chosen.mask(x)
    return rule


def _prune(rule: list[Condition], x: dict[str, np.ndarray], low: np.ndarray) -> tuple[list[Condition], float]:
    """The beginning of the rule with the best (p - n) / (p + n) on held-out rows, and its precision there."""
    best, kept, precision = -2.0, rule, 0.0
    for size in range(1, len(rule) + 1):
        m = _mask(rule[:size], x, len(low))
        p, n = (m & low).sum(), (m & ~low).sum()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best + 1e-9:
            best, kept, precision = worth, rule[:size], p / (p + n) if p + n else 0.0
    return kept, precision


def learn(x: dict[str, np.ndarray], low: np.ndarray, part: np.ndarray) -> list[list[Condition]]:
    """Ordered rules for low quality. part: whole numbers that deal rows out, a third of them to pruning."""
    left, rules = np.ones(len(low), dtype=bool), []
    while True:
        g, h = left & (part % 3 != 0), left & (part % 3 == 0)
        if (g & low).sum() < MIN_COVER:
            break
        rule = _grow({k: v[g] for k, v in x.items()}, low[g])
        if not rule:
            break
        rule, precision = _prune(rule, {k: v[h] for k, v in x.items()}, low[h])
        covered = _mask(rule, x, len(low)) & left
        if precision < MIN_PRECISION or covered.sum() < MIN_COVER:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[list[Condition]]:
    """Rules from at most ``sample`` labelled rows, those of the smallest hashes of doc_id. Without labels: no rules."""
    known = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long"), "quality")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    of = features()
    rows = stats.join(F.broadcast(known), "doc_id").select("doc_id", "quality", *[v.alias(f"f_{k}") for k, v in of.items()]).orderBy("doc_id").limit(2 * sample).toPandas()
    x = {k: rows[f"f_{k}"].to_numpy(dtype=float) for k in of}
    ids = rows["doc_id"].to_numpy(dtype=np.int64)
    return learn(x, rows["quality"].to_numpy(dtype=float) < 0.5, (ids * 2654435761 >> 7) & 0xFFFF)


def verdict(rules: list[list[Condition]]) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    of, out = features(), F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        holds = F.lit(True)
        for c in rules[i - 1]:
            holds = holds & c.column(of)
        out = F.when(holds, F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Counts of every row of docs, base_failed, rule (the first that holds) and kept.

    Null and empty texts have no words and fail the base test. Repeated rows are judged alike, a null doc_id stays null.
    """
    prepare(docs.sparkSession)
    stats = cut(statistics(docs), "rules")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = stats.withColumn("base_failed", failed).withColumn("rule", verdict(fit(stats, labels, sample)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op3_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, labels).select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule")


SQL: dict[str, str] = {}
