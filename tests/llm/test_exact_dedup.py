import hashlib

from llm_rows import docs_of

from kollektiv.llm.common import scratch_path
from kollektiv.llm.exact_dedup import DigestIndex, digests, exact_dedup

ROWS = [(1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, ""), (4, None), (5, "É"), (6, "é"), (7, "x" * 200_000),
        (None, "same text"), (8, "twice"), (8, "twice"), (None, "lost"), (None, "lost")]


def brute(rows):
    groups = {}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(low, []).append(i)
    out = []
    for low, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        at = ids.index(keep)
        out += [(i, keep, len(ids), k == at, hashlib.sha256(low.encode()).hexdigest()) for k, i in enumerate(ids)]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r[:2]) + tuple(map(str, r[2:]))


def test_every_row_gets_its_group(spark):
    got = exact_dedup(docs_of(spark, ROWS), batches=3).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(ROWS), key=key)


def test_empty_table(spark):
    assert exact_dedup(docs_of(spark, [])).count() == 0


def test_index_only_grows_by_what_is_new(spark):
    path = scratch_path(spark, "test-index")
    index = DigestIndex(spark, path, buckets=3)
    index.add(digests(docs_of(spark, [(5, "a"), (6, "A"), (7, "b")])))
    assert sorted(r.keep_id for r in index.entries().collect()) == [6, 7]
    index.add(digests(docs_of(spark, [(9, "a"), (8, "c")])))
    assert sorted(r.keep_id for r in index.entries().collect()) == [6, 7, 8]
    plan = index.entries().hint("merge").join(digests(docs_of(spark, [(1, "a")])), "digest")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan


def test_index_is_opened_again_with_what_it_holds(spark):
    path = scratch_path(spark, "test-index-again")
    first = DigestIndex(spark, path, buckets=3)
    first.add(digests(docs_of(spark, [(6, "A"), (7, "b")])))
    other = spark.newSession()
    again = DigestIndex(other, path, buckets=5)
    again.add(digests(docs_of(other, [(9, "a"), (8, "c")])))
    assert again.buckets == 3 and sorted(r.keep_id for r in again.entries().collect()) == [6, 7, 8]
    rows = exact_dedup(docs_of(spark, [(20, "B"), (21, "c"), (22, "d")]), index_path=path, buckets=2).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in rows) == [(20, 7, False), (21, 8, False), (22, 22, True)]
