from collections import Counter

import pytest
from pyspark.sql import functions as F
from llm_rows import docs_of

from kollektiv.llm import mixing


def water(sizes, weights, share=1.5, most=2):
    """Targets by resharing the excess until nobody is above."""
    total = share * sum(sizes.values())
    open_, fixed = dict.fromkeys(sizes, 0.0), {}
    while True:
        left = total - sum(fixed.values())
        w = sum(weights[s] for s in open_)
        goal = {s: left * weights[s] / w for s in open_}
        over = [s for s in open_ if goal[s] > most * sizes[s]]
        if not over:
            return {**fixed, **goal}
        for s in over:
            fixed[s] = float(most * sizes[s])
            del open_[s]


def corpus():
    rows, i = [], 0
    for s, n in (("a", 40), ("b", 400), ("c", 30), (None, 25), ("é", 60), ("empty", 3)):
        for k in range(n):
            rows.append((i, None if k == 3 else "" if s == "empty" else " ".join(["w"] * (1 + (i * 7919) % 97)), s))
            i += 1
    return rows


def size(t):
    return len((t or "").encode().split())


def test_targets_and_taken(spark):
    rows = corpus()
    got = {r.doc_id: r for r in mixing.mix(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    sizes, ids = Counter(), {}
    for i, t, s in rows:
        sizes[s] += size(t)
        ids.setdefault(s, []).append(i)
    names = sorted([s for s in sizes if s is not None]) + [None]
    goal = water(dict(sizes), {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)})
    for i, t, s in rows:
        r = got[i]
        assert r.size == size(t) and r.source_size == sizes[s] and r.target == pytest.approx(goal[s])
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
    for s, members in ids.items():
        assert abs(sum(got[i].taken for i in members) - goal[s]) <= max(got[i].size for i in members) / 2 + 1e-6
        epochs = int(goal[s] // sizes[s]) if sizes[s] else 0
        assert all(got[i].taken >= epochs * got[i].size for i in members)        # complete epochs first


def test_reruns_and_partitions_agree(spark):
    docs = docs_of(spark, corpus())
    first = sorted(map(tuple, mixing.mix(docs).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_key_ranges_do_not_change_the_mix(spark, monkeypatch):
    docs = docs_of(spark, corpus())
    first = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 9)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert first == sorted(map(tuple, mixing.mix(docs).collect()))


def test_remix_repeats_rows_as_taken(spark):
    docs = docs_of(spark, corpus())
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(docs).collect()}
    out = mixing.remix(docs)
    assert out.columns == docs.columns
    times = Counter(r.doc_id for r in out.collect())
    assert all(times[i] * n == t for i, (t, n) in taken.items())


def test_clean_text_is_drawn_before_noise(spark):
    clean, noisy = [(i, "plain words here now", "a") for i in range(300)], [(1000 + i, "pl%%% wo### he&&& no$$$", "a") for i in range(300)]
    rows = mixing.mix(docs_of(spark, clean + noisy + [(5000 + i, "z " * 40, "b") for i in range(2)]), share=0.5).collect()
    part = {bool(r.doc_id < 1000): 0 for r in rows}
    for r in rows:
        if r.doc_id < 2000:
            part[r.doc_id < 1000] += r.taken
    assert part[True] > 2 * part[False]


def test_empty_table_and_repeated_rows(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    twice = mixing.mix(docs_of(spark, [(1, "a b", "s"), (1, "a b", "s"), (2, "c", "s")])).collect()
    assert len(twice) == 3 and sum(r.taken for r in twice) in (7, 8)                  # target 7.5, ids drawn row by row


def three_sources(ids, texts):
    return [(ids(i), texts(i), s) for s in ("a", "b", "c") for i in range(300)]


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 4, lambda i: i % 2 or None], ids=["null", "one id", "some"])
@pytest.mark.parametrize("texts", [lambda i: "w " * (1 + i % 9), lambda i: "same words in all"], ids=["different", "alike"])
def test_null_and_repeated_ids_meet_their_targets(spark, ids, texts, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rows = three_sources(ids, texts)
    docs = docs_of(spark, rows).repartition(5)
    sized = mixing.sizes_and_keys(docs, 7)
    goal = {r.source: (r.target, r.source_size) for r in mixing.targets(sized).collect()}
    out = mixing.remix(docs.withColumnRenamed("lang", "_MIX_src") if "lang" in docs.columns else docs)
    taken = Counter()
    for r in out.collect():
        taken[r.source] += size(r.text)
    assert all(abs(taken[s] - t) <= 9 / 2 + 1e-6 for s, (t, _) in goal.items())
    got = mixing.mix(docs).collect()
    assert len(got) == 900 and sum(r.taken for r in got) == sum(taken.values())
    assert all(r.taken <= 2 * r.size for r in got)
    key = lambda rs: sorted(map(repr, rs))                                                   # noqa: E731
    assert key(got) == key(mixing.mix(docs.repartition(3)).collect())


def test_sql_agrees_on_null_and_repeated_ids(spark):
    import duckdb

    from kollektiv.llm.queries import ORACLES
    rows = corpus() + [(None, "a b c d", "a")] * 5 + [(None, f"n {'w ' * i}", "b") for i in range(9)] + [(7, "again here", "a")] * 3
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(r) for r in rows])
    want = Counter((r[0], r[1], r[4]) for r in db.execute(ORACLES["op1_mix_sources"]).fetchall())
    got = Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(docs_of(spark, rows)).collect())
    assert got == want


def test_other_columns_may_have_any_name(spark):
    docs = docs_of(spark, corpus())
    for name in ("_mix_src", "_mix_apart", "_MIX_key", "size", "key", "target", "apart", "digest"):
        docs = docs.withColumn(name, F.lit(name))
    out = mixing.remix(docs)
    assert out.columns == docs.columns and out.count() == mixing.remix(docs_of(spark, corpus())).count()


def test_main_path_is_native(spark):
    docs = docs_of(spark, corpus())
    plan = mixing.remix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
