"""Base spans against plain regular expressions, contexts on small corpora, the
graph's rounds against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import docs_of

from kollektiv.llm import personal as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: [int(c) for c in m[0] if c in "0123456789"]
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = digits(m)
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x) // 10 + (2 * x) % 10 for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(s, e, k) for s, k, e in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab0123459.@+-() %_x\nä", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert P.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e@f.g", "x@y", "..@a.b", "a@b..c", "a@b.c.", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.255", "000000255.1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "+1 (017) 555-7713", "+1 2 (", "++49 30 1234567", "4111  1111", "",
    "+123456789012345678", "1.2.3", "@", "a@b-c.d-e"])
def test_base_spans_of_odd_texts(text):
    assert P.base_spans(text) == plain(text)


def test_base_spans_of_real_texts(smoke_docs):
    for _, text in smoke_docs:
        assert P.base_spans(text or "") == plain(text or "")


def test_long_runs_take_linear_time():
    for text in ("7" * 400_000, "a" * 400_000, "1." * 200_000, "a@" * 150_000, "+1" * 100_000, "1 " * 200_000, "(" * 200_000, "a at " * 60_000):
        P.candidates(text, P.base_spans(text))


def spans(rows):
    return {(r.doc_id, r.base_sha256): r.spans for r in rows}


WORDS = "the of and ride stone lamp green over under river small tree house window paper cloud".split()


def corpus(seed=1):
    """Phones follow 'call me at', cards 'card number is'; some in forms that the
    base patterns do not have.  Ticket numbers look alike but stand elsewhere."""
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows, hidden, tickets = [], {}, {}
    for i in range(60):
        kind = i % 6
        num = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
        if kind < 2:
            rows.append((i, f"{say(9)} please call me at +49 30 {num(7)} {say(5)}"))
        elif kind == 2:
            text = f"{say(7)} please call me at "
            hidden[i] = ("phone", len(text), len(text) + 11)
            rows.append((i, f"{text}030 {num(7)} {say(5)}"))
        elif kind == 3:
            text = f"{say(7)} my ticket number is "
            tickets[i] = len(text)
            rows.append((i, f"{text}{num(10)} {say(5)}"))
        elif kind == 4:
            rows.append((i, f"{say(6)} write to me under {rng.choice(WORDS)}{i}@mail{i % 7}.example.com {say(4)}"))
        else:
            text = f"{say(6)} write to me under "
            hidden[i] = ("email", len(text), len(text) + len(f"{WORDS[i % 9]}{i} (at) host dot org"))
            rows.append((i, f"{text}{WORDS[i % 9]}{i} (at) host dot org {say(4)}"))
    return rows, hidden, tickets


def test_contexts_find_unseen_forms_and_leave_others(spark):
    rows, hidden, tickets = corpus()
    got = {r.doc_id: r for r in P.span_digests(P.find_personal(docs_of(spark, rows))).collect()}
    assert len(got) == len(rows)
    for i, (kind, a, b) in hidden.items():
        assert got[i].spans == f"{kind}:{a}:{b}" and not got[i].n_phone and not got[i].n_email
    for i in tickets:
        assert got[i].spans == ""
    assert sum(r.n_phone for r in got.values()) == 20 and sum(r.n_email for r in got.values()) == 10


def brute_rounds(rows, rounds, support, sure, accept):
    """The graph of ``find_personal`` in plain Python: doc -> added spans."""
    edges, seed, kinds, found = defaultdict(set), {}, defaultdict(int), []
    for doc, text in rows:
        base = P.base_spans(text or "")
        every = [(a, b, k, 1 << k) for a, b, k in base] + [(a, b, -1, k) for a, b, k in P.candidates(text or "", base)]
        for a, b, k, ks in every:
            inst = text[a:b].lower()
            ps = P.contexts(text, a, b)
            for p in ps:
                edges[p].add(inst)
                kinds[p, inst] |= ks
            if k >= 0 and ps:
                seed[inst] = min(k, seed.get(inst, 9))
            elif k < 0:
                found.append((doc, a, b, ks, inst, ps))
    known = {i: (k, 1.0) for i, k in seed.items()}
    good = {}
    for _ in range(rounds):
        good = {}
        for p, insts in edges.items():
            for k in range(4):
                have = [known[i][1] for i in insts if i in known and known[i][0] == k]
                neg = sum(i in known and known[i][0] != k for i in insts)
                unk = sum(i not in known and bool(kinds[p, i] >> k & 1) for i in insts)
                conf = sum(have) / max(sum(have) + neg + P.UNKNOWN * unk, 1e-9)
                if len(have) >= support and conf >= sure:
                    good[p, k] = conf
        doubt = defaultdict(lambda: 1.0)
        for p, insts in edges.items():
            for i in insts - set(seed):
                for k in range(4):
                    if (p, k) in good and kinds[p, i] >> k & 1:
                        doubt[i, k] *= max(1 - good[p, k], 1e-3)
        known = {i: (k, 1.0) for i, k in seed.items()}
        best = {}
        for (i, k), d in doubt.items():
            if 1 - d >= accept and (i not in best or (1 - d, -k) > best[i]):
                best[i] = (1 - d, -k)
        known |= {i: (-k, s) for i, (s, k) in best.items()}
    return sorted((doc, a, b, known[i][0]) for doc, a, b, _, i, ps in found
                  if i in known and any((p, known[i][0]) in good for p in ps))


@pytest.mark.parametrize("support,sure", [(4, 0.8), (1, 0.3)])
def test_rounds_equal_plain_python(spark, smoke_docs, support, sure):
    rows = corpus(3)[0] + [(1000 + i, t) for i, t in smoke_docs]
    want = brute_rounds(rows, 3, support, sure, P.ACCEPT if support == 4 else 0.3)
    got = P.find_personal(docs_of(spark, rows), support=support, sure=sure, accept=P.ACCEPT if support == 4 else 0.3).collect()
    assert sorted((r.doc_id, s.start, s.end, s.kind) for r in got for s in r.added) == want and want


def test_nulls_repeated_rows_and_extra_columns(spark):
    text = "ä€ mail x.y@a.b.c or +1 (017) 555-7713 at 10.0.0.1, 4111 1111 1111 1111"
    rows = [(None, text), (None, None), (1, text), (1, text), (2, ""), (3, "no data here")]
    got = P.span_digests(P.find_personal(docs_of(spark, rows))).collect()
    assert len(got) == 6
    line = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, b, k in plain(text))
    full = [r for r in got if r.spans]
    assert len(full) == 3 and all(r.spans == line and r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
                                  and (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1) for r in full)
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if not r.spans)
    assert P.span_digests(P.find_personal(docs_of(spark, []))).count() == 0
