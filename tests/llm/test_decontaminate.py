import random

from llm_rows import docs_of

from kollektiv.llm import decontaminate as D


def grams(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, percent=80):
    out = []
    for i, t in items:
        n = len((t or "").split())
        k = min(n, 5)
        want = grams(t, k) if k else set()
        for d, text in docs:
            both = len(want & grams(text, k)) if k else 0
            if want and 100 * both >= percent * len(want):
                out.append((d, i, len(want), both))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"t{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([5, 8, 20, 45, 130])))) for i in range(25)]
    items += [(100, "only three words"), (101, "one"), (102, ""), (103, None), (None, items[0][1]), (3, items[3][1])]
    docs = []
    for d in range(120):
        w = rnd.choices(vocab, k=rnd.choice([0, 30, 400, 2500]))
        if d % 3 == 0:
            item = (rnd.choice(items)[1] or "").split()
            if d % 2 and len(item) > 12:           # a few words changed, or cut short
                for _ in range(rnd.randrange(4)):
                    item[rnd.randrange(len(item))] = "changed"
            at = rnd.randrange(len(w) + 1)
            half = len(item) // 2
            w = w[:at] + item[:half] + (w[:3] if d % 12 == 0 else []) + item[half:] + w[at:]
        docs.append((d, " ".join(w)))
    return docs + [(None, items[1][1]), (900, None), (901, ""), (902, items[2][1].upper()), (902, items[2][1].upper())], items


def items_of(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, lang string")


def test_all_contained_items_are_found(spark):
    docs, items = corpus(1)
    got = D.contained(docs_of(spark, docs).repartition(3), items_of(spark, items)).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in got), key=str) == brute(docs, items)
    assert all(r.containment == r.n_common / r.n_shingles for r in got)


def test_blocks_of_items_change_nothing(spark):
    docs, items = corpus(2)
    got = D.contained(docs_of(spark, docs), items_of(spark, items), block=4).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in got), key=str) == brute(docs, items)


def test_clean_keeps_the_other_rows_whole(spark):
    docs, items = corpus(3)
    bad = {(d, dict(docs)[d]) for d, _, _, _ in brute(docs, items)}
    out = D.clean(docs_of(spark, docs), items_of(spark, items))
    assert out.columns == docs_of(spark, []).columns
    left = sorted([(r.doc_id, r.text) for r in out.collect()], key=str)
    assert left == sorted([d for d in docs if d not in bad], key=str)


def test_empty_tables(spark):
    docs, items = corpus(4)
    assert D.contained(docs_of(spark, []), items_of(spark, items)).count() == 0
    assert D.contained(docs_of(spark, docs), items_of(spark, [])).count() == 0
    assert D.clean(docs_of(spark, docs), items_of(spark, [])).count() == len(docs)


def test_items_of_one_shingle_are_never_missed():
    import pyarrow as pa

    from kollektiv.llm.decontaminate import Items
    n = 2000
    items = Items.of(list(range(n)), [f"i{k}a i{k}b i{k}c i{k}d i{k}e" for k in range(n)])
    texts = [f"x{k} y{k} z{k} u{k} i{k}a i{k}b i{k}c i{k}d i{k}e v{k} r{k} s{k} t{k}" for k in range(n)]
    assert items.matches(pa.array(texts)) == [(k, k, 1) for k in range(n)]
