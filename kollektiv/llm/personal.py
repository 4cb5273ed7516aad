"""Personal data: patterns for the usual forms, contexts learnt for the others.

**Base spans.**  E-mail addresses, IP addresses, card numbers and phone numbers by
fixed patterns (``BASE``); leftmost and non-overlapping by kind; matches that fail
a kind's test (parts, digits, Luhn) are dropped.  The patterns are written so that
each reads a text once, however long its runs of digits or letters are.

**Contexts.**  Other identifier-like tokens (numbers with seven digits or more in
any grouping, addresses spelt ``name at host dot org`` or without a dot, IP
addresses of another form) are candidates for the kinds their form allows.  An
occurrence's lexical patterns are the words around it: the two on its left, the
three on its left, the one on its left with the one on its right.  Words are lower
case, digits read as 0, punctuation at their ends is left off.

**Bootstrapping.**  Base spans are the seed entities.  Patterns and instances are
a graph with an edge where an instance stands in a pattern.  In each of
``ROUNDS`` rounds a pattern's confidence for a kind is::

    positive / (positive + negative + UNKNOWN * unknown)

over its distinct instances: the scores of those known to be of the kind, the
number known to be of others, and the number of undecided ones that could be of
that kind.  Patterns of confidence ``SURE`` or more with ``SUPPORT`` instances of
the kind count; an undecided instance scores ``1 - product(1 - confidence)`` over
those patterns that hold it, and is known from ``ACCEPT`` on, which lets it raise
further patterns.  The occurrences of candidates that end up known, in a pattern
that counts for their kind, become spans where they overlap no base span.

The graph's rows are the distinct (pattern, instance) pairs, a small part of the
text; rounds are Spark joins and aggregations of it, staged in the shared folder.
Instances and patterns are known by 64-bit hashes.

Null texts count as empty; empty texts have no spans.  Rows are told apart by a
number of their own, so repeated and null ids give a row each.  Copies of a text
add no evidence: an instance counts once for a pattern.  Empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm.common import arrow_map, stage_table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ROUNDS, SUPPORT, SURE, ACCEPT, UNKNOWN = 3, 4, 0.8, 0.8, 0.25

# fixed values: the forms of the base kinds.  A match starts where a run of its
# characters starts, and takes runs whole, which is what leftmost greedy matching
# gives; an address is found by its @.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# what could be an identifier of some kind
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().:/_-]{0,2}[0-9])++(?![0-9A-Za-z])")
_SPELT = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64})(?:@| ?[(\[] ?at ?[)\]] ?| at )"
                    r"([A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[] ?dot ?[)\]] ?| dot )[A-Za-z0-9-]{1,63}){0,8})(?![A-Za-z0-9])")
_HEX_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_INTERESTING = re.compile(r"[0-9@]| at |[(\[] ?at")
_TRIM = " \t\n\r\x0b\x0c.,;:!?()[]{}<>\"'*|$%&#"
_ZEROS = str.maketrans("123456789", "000000000")
#: Code points on either side of an occurrence that its patterns are read from.
_AROUND = 120


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _emails(text: str):
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base forms, by start, then kind."""
    out = [(a, b, EMAIL) for a, b in _emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((*m.span(), IP))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((*m.span(), CARD))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((*m.span(), PHONE))
    return sorted(out, key=lambda s: (s[0], s[2]))


_HAS_DIGIT = re.compile(r"[0-9]")


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kinds) of identifier-like tokens that touch no base span;
    kinds has a bit for each kind that the form allows."""
    found = []
    if "@" in text or " at " in text or "(at" in text or "[at" in text or "at)" in text or "at]" in text:
        found += [(*m.span(), 1 << EMAIL) for m in _SPELT.finditer(text) if m[0].count(" ") < 2 or "dot" in m[0]]
    if _HAS_DIGIT.search(text):
        found += [(*m.span(), 1 << IP) for m in _HEX_IP.finditer(text)]
        for m in _NUMBER.finditer(text):
            n = len(_digits(m[0]))
            if n >= 7:
                found.append((*m.span(), (1 << CARD) * (12 <= n <= 19) | (1 << PHONE) * (n <= 15)
                              | (1 << IP) * (m[0].count(".") == 3)))
    out, end, i = [], 0, 0
    for start, stop, kinds in sorted(found):
        while i < len(base) and base[i][1] <= start:
            i += 1
        j = i
        while j < len(base) and base[j][0] < stop and base[j][1] <= start:
            j += 1
        if kinds and start >= end and not (j < len(base) and base[j][0] < stop):
            out.append((start, stop, kinds))
            end = stop
    return out


def contexts(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around text[start:end]."""
    word = lambda w: w.strip(_TRIM).lower().translate(_ZEROS)
    left = [word(w) for w in text[max(0, start - _AROUND):start].split()[-3:]]
    right = [word(w) for w in text[end:end + _AROUND].split()[:2]]
    left, right = [w for w in left if w], [w for w in right if w]
    forms = []
    if len(left) >= 2:
        forms.append(f"2 {left[-2]} {left[-1]}")
    if len(left) >= 3:
        forms.append(f"3 {left[-3]} {left[-2]} {left[-1]}")
    if left and right:
        forms.append(f"m {left[-1]} _ {right[0]}")
    return [xxhash.xxh64_intdigest(f) - (1 << 63) for f in forms]


_SPANS = "array<struct<start:int,end:int,kind:int>>"
_FOUND = ("array<struct<start:int,end:int,kind:int,kinds:int,instance:long,patterns:array<long>>>")


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base, found): base spans, and all occurrences, seeds (kind 0 or more)
    and candidates (kind -1), with their patterns."""
    kind = docs.select(id_col).schema[0].dataType
    span = pa.struct({"start": pa.int32(), "end": pa.int32(), "kind": pa.int32()})
    item = pa.struct({"start": pa.int32(), "end": pa.int32(), "kind": pa.int32(), "kinds": pa.int32(),
                      "instance": pa.int64(), "patterns": pa.list_(pa.int64())})

    def find(batch: pa.RecordBatch):
        bases, founds = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            if not _INTERESTING.search(text):
                bases.append([])
                founds.append([])
                continue
            base = base_spans(text)
            bases.append([{"start": a, "end": b, "kind": k} for a, b, k in base])
            every = [(a, b, k, 1 << k) for a, b, k in base] + [(a, b, -1, k) for a, b, k in candidates(text, base)]
            founds.append([{"start": a, "end": b, "kind": k, "kinds": ks,
                            "instance": xxhash.xxh64_intdigest(text[a:b].lower()) - (1 << 63),
                            "patterns": contexts(text, a, b)} for a, b, k, ks in every])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bases, pa.list_(span)), pa.array(founds, pa.list_(item))],
                                         names=["id", "base", "found"])

    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), find,
                     f"id {kind.simpleString()}, base {_SPANS}, found {_FOUND}")


def patterns_of(edges: DataFrame, known: DataFrame, support: int, sure: float) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that count.  ``edges`` are the
    distinct (pattern, instance, kinds); ``known`` has (instance, kind, score)."""
    rows = edges.join(known, "instance", "left")
    sums = []
    for k in range(len(KINDS)):
        mine = F.col("kind") == k
        could = F.col("kind").isNull() & (F.col("kinds").bitwiseAND(F.lit(1 << k)) != 0)
        sums += [F.sum(F.when(mine, F.col("score")).otherwise(0.0)).alias(f"positive{k}"),
                 F.count_if(mine).alias(f"support{k}"),
                 F.count_if(F.col("kind").isNotNull() & ~mine).alias(f"negative{k}"),
                 F.count_if(could).alias(f"unknown{k}")]
    per = rows.groupBy("pattern").agg(*sums)
    each = per.select("pattern", F.explode(F.array(*(F.struct(
        F.lit(k).alias("kind"), F.col(f"support{k}").alias("support"),
        (F.col(f"positive{k}") / F.greatest(F.col(f"positive{k}") + F.col(f"negative{k}") + UNKNOWN * F.col(f"unknown{k}"),
                                            F.lit(1e-9))).alias("confidence")) for k in range(len(KINDS))))).alias("s"))
    return (each.select("pattern", "s.kind", "s.support", "s.confidence")
            .filter((F.col("support") >= support) & (F.col("confidence") >= sure)).drop("support"))


def instances_of(edges: DataFrame, patterns: DataFrame, seeds: DataFrame, accept: float) -> DataFrame:
    """(instance, kind, score): the seeds, and undecided instances that patterns
    make known; of several kinds the likeliest, then the first."""
    held = edges.filter("not seed").join(patterns, "pattern").filter("(kinds & shiftleft(1, kind)) != 0")
    doubt = F.log(F.greatest(1.0 - F.col("confidence"), F.lit(1e-3)))
    scored = held.groupBy("instance", "kind").agg((1.0 - F.exp(F.sum(doubt))).alias("score")).filter(F.col("score") >= accept)
    best = scored.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
    return seeds.union(best.select("instance", (-F.col("b.k")).alias("kind"), F.col("b.score").alias("score")))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                  support: int = SUPPORT, sure: float = SURE, accept: float = ACCEPT) -> DataFrame:
    """(id, base, added): spans (start, end, kind) of the base forms, by start,
    then kind, and those that contexts add; code points, end exclusive."""
    rows = stage_table(scan(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "scanned")
    each = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    # an instance of a base form anywhere is a seed everywhere
    seen = each.select("instance", "kind", "kinds", F.explode("patterns").alias("pattern"))
    edges = stage_table(seen.groupBy("pattern", "instance").agg(
        F.max("kind").alias("seed_kind"), F.bit_or("kinds").alias("kinds"))
        .select("pattern", "instance", "kinds", (F.col("seed_kind") >= 0).alias("seed"), "seed_kind"), "edges")
    seeds = stage_table(edges.filter("seed").groupBy("instance").agg(F.min("seed_kind").alias("kind"))
                        .withColumn("score", F.lit(1.0)), "seeds")
    edges = edges.drop("seed_kind")
    known, patterns = seeds, None
    for _ in range(rounds):
        patterns = stage_table(patterns_of(edges, known, support, sure), "patterns")
        known = stage_table(instances_of(edges, patterns, seeds, accept), "known")
    open_ = each.filter("kind < 0").select("row", "start", "end", "kinds", "instance", F.explode("patterns").alias("pattern"))
    if patterns is None:
        added = open_.limit(0).select("row", F.array().cast(_SPANS).alias("added"))
    else:
        added = (open_.join(known, "instance").join(patterns, ["pattern", "kind"])
                 .select("row", "start", "end", "kind").distinct()
                 .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("added")))
    return (rows.join(added, "row", "left")
            .select(F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast(_SPANS)).alias("added")))


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and the text of all spans."""
    names = F.array(*(F.lit(k) for k in KINDS))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    order = lambda a, b: F.when((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"])), -1).otherwise(1)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(line(F.col("base")), 256).alias("base_sha256"),
        line(F.array_sort(F.concat("base", "added"), order)).alias("spans"))
