import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import docs_of

from kollektiv.llm import phrase_dedup as P
from kollektiv.llm import words as W


def brute(rows, n=20):
    """Windows in order of (id, text); rows alike in both are one document."""
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    unique = sorted({(i is None, i or 0, digest(t), t or "") for i, t in rows})
    first, out = {}, {}
    for place, (none, i, _, text) in enumerate(unique):
        w = text.encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if first.setdefault(tuple(w[p:p + n]), (place, p)) != (place, p):
                gone[p:p + n] = [True] * n
        out[None if none else i, text] = (len(w), sum(gone), hashlib.sha256(
            b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return sorted(((i is None, i or 0, *out[i, t or ""]) for i, t in rows))


def result(spark, rows, parts=4):
    got = P.phrase_dedup(docs_of(spark, rows).repartition(parts)).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got)


def corpus(seed, unique_ids=True):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "the", "The"]
    passages = [" ".join(rnd.choices(vocab, k=rnd.choice([19, 20, 21, 45, 300]))) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randrange(4)):
            parts.append(" ".join(rnd.choices(vocab, k=rnd.randrange(30))))
            parts.append(rnd.choice(passages))
        if i % 9 == 0:
            words = rnd.choice(passages).split()
            parts.append(" ".join(words[3:24]))
        rows.append((i if unique_ids else i % 25, rnd.choice([" ", "\n", "\t "]).join(parts)))
    return rows


def test_random_corpora_match_brute_force(spark):
    assert result(spark, corpus(1)) == brute(corpus(1))


def test_small_shards_and_passages_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_BYTES", 2_000)
    rows = corpus(2)
    assert result(spark, rows) == brute(rows)


def test_edge_cases_match_brute_force(spark):
    line = " ".join(f"x{i}" for i in range(20))
    rows = corpus(3, unique_ids=False) + [
        (None, line), (None, None), (100, ""), (101, None), (102, line), (103, line.upper()), (104, line + " " + line),
        (105, "again " * 3000), (106, "again " * 25), (107, "a b " * 400), (1, line), (1, line), (108, " ".join(f"x{i}" for i in range(19)))]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert P.phrase_dedup(docs_of(spark, [])).count() == 0


def test_smoke_table_matches_brute_force(spark, smoke_docs):
    assert result(spark, smoke_docs) == brute(smoke_docs)


@pytest.mark.parametrize("span", [1, 2, 5, 13])
def test_chosen_is_the_leftmost_least(span):
    g = np.random.default_rng(0).integers(0, 9, 200, dtype=np.uint64)
    got = P._chosen(g, span)
    assert got.tolist() == [i + int(np.argmin(g[i:i + span])) for i in range(len(g) - span + 1)]


def test_automaton_leaves_the_first_occurrence():
    words = [f"w{i}".encode() for i in range(30)]
    auto = P.Automaton([5], [2], pa.array([b" ".join(words)]))
    for key, doc, want in ((9, words, 30), (5, [b"a", b"b", *words], 0), (4, words, 0), (5, [b"a"] * 10 + words, 30), (9, words[:19], 0)):
        w = W.Words(pa.array([b" ".join(doc)]))
        assert auto.removed(w, [key]).sum() == want


def test_a_phrase_of_every_passage_does_not_send_each_passage_to_every_shard(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_BYTES", 4_000)
    common = " ".join(f"c{i}" for i in range(15))
    rows = []
    for i in range(200):
        text = " ".join(f"a{i}x{k}" for k in range(15)) + " " + common + " " + " ".join(f"b{i}x{k}" for k in range(15))
        rows += [(2 * i, text), (2 * i + 1, "other start " + text)]
    sent, whole = [], P.found

    def found(docs, routed):
        sent.extend(len(r.words) for r in routed.collect())
        return whole(docs, routed)
    monkeypatch.setattr(P, "found", found)
    assert result(spark, rows) == brute(rows)
    # each pair's passage goes to the shard of its second document
    assert 0 < sum(sent) <= sum(len(t) for _, t in rows)


def test_windows_that_recur_in_many_batches_and_shards(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_BYTES", 3_000)
    monkeypatch.setattr(P, "_ROWS", 7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    line = " ".join(f"x{i}" for i in range(24))
    rows = [(i, f"{i} {line} {line[:i]}") for i in range(90)] + corpus(4)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    try:
        assert result(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
