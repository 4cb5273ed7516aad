"""Runs against trying every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import docs_of

from kollektiv.llm import runs


def brute(words):
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def cases():
    rng = random.Random(5)
    yield from ("", " \n ", "a", "a " * 11, "a " * 12, "a b " * 6, "x " + "a b " * 6 + "y", "a b c d e f " * 2, "a b c d e f g " * 2)
    yield ("a " * 300).strip()
    yield " ".join(["a b a b a b a b a b a b c"] * 9)
    for _ in range(150):
        kinds, n = rng.choice([2, 2, 3, 5, 50]), rng.randrange(0, 160)
        words = [rng.choice("abcdefghij"[:kinds] if kinds < 10 else "abcdefghijklmnopqrstuvwxyz") for _ in range(n)]
        if rng.random() < 0.7 and n > 20:
            a, p = rng.randrange(n), rng.randrange(1, 12)
            b = min(n, a + rng.randrange(10, 80))
            for i in range(a, b):
                words[i] = words[a + (i - a) % p]
        yield " ".join(words)
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    yield " ".join(fib[-1])


def test_runs_equal_brute_force():
    texts = list(cases())
    found, _ = runs.runs_of_texts(pa.array(texts))
    for text, got in zip(texts, found, strict=True):
        assert [tuple(r) for r in got.tolist()] == brute(text.split()), text[:200]


def test_merges_of_large_children():
    line = [f"w{i}" for i in range(40)]
    words = (line * 90) + ["x"] + (line * 80) + ["y", "y"] + line[:7] * 100
    found, _ = runs.runs_of_texts(pa.array([" ".join(words), " ".join(words)]))
    assert [tuple(r) for r in found[0].tolist()] == [tuple(r) for r in found[1].tolist()] == brute(words)


def test_suffix_array_and_shared_lengths():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 3, 200), [9]])
    order, shared = runs.suffix_array(x)
    as_lists = [x[i:].tolist() for i in order]
    assert as_lists == sorted(as_lists)
    for a, b, n in zip(as_lists, as_lists[1:], shared[1:], strict=False):
        assert n == next(i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q)


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_rows_equal_brute_force(spark, smoke_docs):
    rng = random.Random(2)
    rows = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in smoke_docs]
    rows += [(None, "a b " * 20), (None, None), (7, ""), (7, "ä ö " * 9), (8, "ä ö " * 12), (8, "ä ö " * 12)]
    rows += [(1000 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(120)))) for i in range(120)]
    got = runs.run_digests(runs.periodic_runs(runs.plant(docs_of(spark, rows)))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    want = []
    for i, t in rows:
        kept = planted(i, words(t))
        found = brute(kept)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None,) * 3
        drop = {j for s, length, q in found for j in range(s + q, s + length)}
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
                     sha(" ".join(x for j, x in enumerate(kept) if j not in drop))))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert runs.run_digests(runs.periodic_runs(runs.plant(docs_of(spark, [])))).count() == 0


@pytest.mark.parametrize("n", [20000])
def test_long_text(n):
    words = [str(i % 997) for i in range(n)]
    (found,), _ = runs.runs_of_texts(pa.array([" ".join(words)]))
    assert found.tolist() == [[0, n, 997]]
