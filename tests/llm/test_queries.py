"""Registered queries over whole tables: against SQL where SQL can express them, against plain Python elsewhere."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import differences
from fixtures import WORD
from tokenizers import Tokenizer

from fogon.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(con):
    return con.sql("select doc_id, coalesce(text, '') from documents").fetchall()


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_as_sql(spark, sf_dir, con, name):
    assert differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == []


def test_packing(spark, sf_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries()["op1_curve_packing"](spark, sf_dir).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert len(by_doc) == len(texts)
    for doc, text in texts:
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == pieces[0].sequence_length and at & (at - 1) == 0 and at <= 2048


def test_statistics_and_verdicts(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries()["op3_decision_list"](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    for doc, text in texts:
        w, seen, dup = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {p for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        r = rows[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_bpe_ids_and_round_trip(spark, sf_dir, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: tuple(r)[1:] for r in queries()["op7_bpe_words"](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    for doc, text in texts:
        ids = library.encode_ordinary(text)
        assert rows[doc] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def plain_spans(text):
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m.group(1)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def test_secrets(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries()["op10_secret_scan"](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    for doc, text in texts:
        spans, r = plain_spans(text), rows[doc]
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_toxicity_on_held_out_documents(spark):
    """Fitted on labels of even ids, right on those of odd ids."""
    from pyspark.sql import functions as F

    from fogon.llm import op5_toxicity as op5

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = op5.fit(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    scored = op5.score(docs.select("doc_id", "text"), model).join(labels.filter("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("label")), "doc_id")
    n = {(r.label, r.toxic): r["count"] for r in scored.groupBy("label", "toxic").count().collect()}
    assert n.get((0, True), 0) <= 0.02 * (n[(0, False)] + n.get((0, True), 0))
    assert n[(1, True)] >= 0.75 * (n[(1, True)] + n.get((1, False), 0))


def test_decision_list_on_held_out_documents(spark):
    from fogon.llm import op3_rules as op3

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    judged = op3.judge(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1").select("doc_id", "quality"), "doc_id").filter("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * n[(1, True)]
    assert n.get((0, True), 0) <= 0.2 * n[(0, False)]
