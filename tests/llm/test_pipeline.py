import random

import corpus_pipeline as C
import pytest
from llm_rows import DOCS, docs_of
from pyspark.sql import functions as F
from test_decontaminate import brute as contained
from test_prefix_join import brute as linked

WORDS = [f"p{i}" for i in range(400)]


def tables(spark, folder, rows, items, marks):
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    text = lambda n: rnd.choices(WORDS, k=n)
    items = [(i, " ".join(text(20))) for i in range(5)]
    rows, marks = [], []
    for i in range(400):
        w, toxic = text(rnd.randrange(20, 60)), i % 7 == 0
        if toxic:
            w[3:3] = ["vile", "nasty", "vile"]
        if i % 11 == 5:
            w = rows[i - 5][1].split() if i % 2 else rows[i - 5][1].split() + ["more"]
        if i % 13 == 6:
            w += items[i % 5][1].split()
        rows.append((i, " ".join(w), f"src{i % 3}"))
        marks.append((i, 1, int("nasty" in w)))
    rows += [(1000, None, "src1"), (1001, "", None), (1002, "", "src0"), (None, " ".join(text(30)), "src2")]
    return rows, items, marks


def test_stages_one_by_one(spark, tmp_path, corpus):
    rows, items, marks = corpus
    folder = str(tmp_path / "in")
    tables(spark, folder, rows, items, marks)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    names = [n for n, _ in C.STAGES]
    assert names == ["toxicity", "near duplicates", "decontamination", "mixing", "tokens"]
    for n, (name, stage) in enumerate(C.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()] if "text" in docs.columns else []
        out = stage(spark, docs, folder)
        assert n == 4 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            kept[name] = (before, [(r.doc_id, r.text) for r in docs.collect()])
    before, after = kept["toxicity"]
    toxic = {i for i, t in before if t and "nasty" in t}
    ids = {i for i, _ in after}
    assert len(toxic & ids) <= 0.05 * len(toxic) and len([i for i, _ in before if i not in toxic and i not in ids]) <= 0.02 * len(before)
    before, after = kept["near duplicates"]
    stay = {(None if r[0] else r[1]) for r in linked(before, 5, 80) if (r[0], r[1]) == (r[3], r[4])}
    assert {i for i, _ in after} == stay and len(after) == len(stay)      # ids are unique here but for one null
    before, after = kept["decontamination"]
    bad = {d for d, _, _, _ in contained(before, items)}
    assert sorted((i for i, _ in after), key=str) == sorted((i for i, _ in before if i not in bad), key=str) and bad
    before, after = kept["mixing"]
    total = lambda x: sum(len((t or "").split()) for _, t in x)
    assert abs(total(after) - 1.5 * total(before)) <= 4 * 60 and set(after) <= set(before)
    tokens = docs.orderBy("start").collect()
    assert len(tokens) == len(after) and sum(r.n_tokens for r in tokens[:-1]) == tokens[-1].start


def test_run_and_extra_columns_and_empty_tables(spark, tmp_path, corpus):
    rows, items, marks = corpus
    tables(spark, str(tmp_path / "in"), rows[:60], items, marks)
    assert C.run(spark, str(tmp_path / "in")).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    tables(spark, str(tmp_path / "none"), [], items[:0], marks[:0])
    assert C.run(spark, str(tmp_path / "none")).count() == 0
    assert C.ORACLE_SQL is None and DOCS


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    rnd = random.Random(4)
    a, b, c, d = (rnd.choices(WORDS, k=40) for _ in range(4))
    say = " ".join
    rows = [(None, say(a)), (3, say(a)), (3, say(a)), (3, say(a[:39] + ["x"])), (5, say(b)), (5, say(c)), (None, say(b)), (None, say(d)),
            (None, None), (None, ""), (9, ""), (9, "")]
    got = sorted(((r.doc_id, r.text) for r in C.drop_near_copies(spark, docs_of(spark, rows), "").collect()), key=str)
    # of the copies of a one row with the smallest id; b and c once; texts without words are no one's copies
    assert len([r for r in got if r[1] and r[1].split()[:30] == a[:30]]) == 1 and got.count((5, say(b))) == got.count((5, say(c))) == 1
    assert (None, say(d)) in got and sum(not t for _, t in got) == 4 and len(got) == 8


def test_columns_may_have_any_name(spark, tmp_path, corpus):
    rows, items, marks = corpus
    folder = str(tmp_path / "in")
    tables(spark, folder, rows[:80], items, marks)
    names = ("score", "whole", "peak3", "predicted", "_stay", "stay", "number", "component_id", "_mix_times", "column0", "before")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    for name, stage in C.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        for r in docs.filter("doc_id is not null").collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in names), name
