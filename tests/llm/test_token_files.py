import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import docs_of

from kollektiv.llm import token_files as T
from kollektiv.llm.common import scratch_path

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
ALPHABET = "ab Z'\n\t\r.1é漢\xa0\x0b\x1c "


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=ALPHABET, max_size=25), st.text(max_size=15).filter(lambda t: t.isprintable())), max_size=5))
def test_pieces_encode_like_whole_texts(texts):
    enc = T.encoder(PATH)
    want = [x.ids for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert [x.tolist() for x in enc.encode(texts)] == want


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 2)
    enc = T.Encoder(PATH)
    for text in ("one two three four", "five six", "one two", "  ", "x<|endoftext|> y"):
        assert enc.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24]), max_size=40))
def test_code_round_trip(values):
    control, data = T.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert T.unpack(control, data, len(values)).tolist() == values
    if values:
        with pytest.raises(ValueError):
            T.unpack(control, data + b"x", len(values))


def brute(tokenizer, rows):
    out, start = [], 0
    coded = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    for i, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), crc(r[1]))):
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("part_ids", [T.PART_IDS, 50])
def test_files_hold_every_document_in_order(spark, tokenizer, part_ids):
    rows = [(i, f"word{i % 5} the end " * (i % 7)) for i in range(60)] + [(7, "again"), (7, "again"), (None, "no id"), (100, None), (101, "é" * 50_000)]
    path = scratch_path(spark, "t-tokens")
    T.write_tokens(docs_of(spark, rows).repartition(5), path, PATH, part_ids=part_ids)
    got = T.layout(T.checksums(spark, path)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(tokenizer, rows)
    stored = T.read_tokens(spark, path).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in stored) == sorted(
        (i is not None, i or 0, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows)
    # ids of a part are below those of the next
    ends = {}
    for r in stored:
        if r.doc_id is not None:
            lo, hi = ends.get(r.part, (r.doc_id, r.doc_id))
            ends[r.part] = (min(lo, r.doc_id), max(hi, r.doc_id))
    spans = [ends[p] for p in sorted(ends)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)) and (part_ids != 50 or len(spans) > 3)
    first = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    assert [r.n for r in first] == sorted([r.n for r in first], reverse=True)


def test_empty_table(spark):
    path = scratch_path(spark, "t-tokens")
    T.write_tokens(docs_of(spark, []), path, PATH)
    assert T.layout(T.checksums(spark, path)).count() == 0


def test_damage_is_noticed(spark):
    from pyspark.sql import functions as F
    path, bad = scratch_path(spark, "t-tokens"), scratch_path(spark, "t-bad")
    T.write_tokens(docs_of(spark, [(1, "some words here")]), path, PATH)
    spark.read.parquet(f"{path}/tokens").withColumn("ids_crc32", F.col("ids_crc32") + 1).write.partitionBy("part").parquet(f"{bad}/tokens")
    spark.read.parquet(f"{path}/vocabulary").write.parquet(f"{bad}/vocabulary")
    with pytest.raises(Exception, match="checksum"):
        T.read_tokens(spark, bad).collect()
