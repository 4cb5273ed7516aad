"""Token ids in files: frequency-ranked, variable-length, control bytes apart.

Ids are renumbered by falling corpus frequency, so most need one byte.  A
document is stored as two byte strings: *control*, two bits per id (bytes used
less one, four ids to a byte, lowest bits first), and *data*, the ranks in 1 to
4 little-endian bytes.  Decoding looks the lengths up in a 256-row table,
gathers four bytes at each start and masks them.

A file set is a folder with ``vocabulary`` (rank, id, n) and ``tokens``:
Parquet in folders ``part=0, 1, ...`` whose documents (doc_id, n_tokens,
control, data, ids_crc32) ascend within and across parts.

Texts are encoded with the ``tokenizers`` library.  Its byte-level pattern
never joins a character to white space after it, so a text is cut before each
run of white space and equal pieces are encoded once per worker; texts with
white space beyond blank, tab, LF and CR go to the library whole.

Defined cases: null text is empty (the end id only); null ids sort first;
equal ids are ordered by length and checksum; an empty table gives an empty
file set; other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kollektiv.llm.common import arrow_map, byte_slices, scratch_path

#: Ids per part of a file set.
PART_IDS = 8_000_000
#: Pieces whose ids a worker remembers.
REMEMBERED = 800_000
END_ID = 0

_PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


class Encoder:
    """Texts to ids; remembers the ids of pieces between calls."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # a byte-level token has a character for each byte it stands for
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has.  The
        pieces begin with white space, end in none and so join to one text, cut
        again by the bytes that its tokens stand for."""
        got = self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids
        ids = np.array(got, np.uint32)
        ends = np.cumsum(self.bytes[ids])
        wanted = np.cumsum([len(p.encode()) for p in pieces])
        cut = np.searchsorted(ends, wanted) + 1
        if len(ends) != cut[-1] or not np.array_equal(ends[cut - 1], wanted):
            each = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return np.fromiter((i for x in each for i in x), np.uint32), np.array([len(x) for x in each], np.int64)
        return ids, np.diff(cut, prepend=0)

    def _learn(self, pieces: list[str]) -> None:
        inner = [p for p in pieces if p[0] in " \t\n\r" and p[-1] not in " \t\n\r"]
        other = [p for p in pieces if not (p[0] in " \t\n\r" and p[-1] not in " \t\n\r")]
        for part in [inner[e:e + 2000] for e in range(0, len(inner), 2000)] + [[p] for p in other]:
            ids, sizes = self._ids(part)
            first, total = len(self.index), len(ids)
            while self.used + total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while first + len(part) > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
                self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.flat[self.used:self.used + total] = ids
            self.length[first:first + len(part)] = sizes
            self.start[first:first + len(part)] = self.used + np.cumsum(sizes) - sizes
            self.used += total
            self.index.update(zip(part, range(first, first + len(part)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (without the end id)."""
        if not texts:
            return []
        cut = [([t] if t else []) if _OTHER_SPACE.search(t) else _PIECE.findall(t) for t in texts]
        pieces = list(chain.from_iterable(cut))
        if len(self.index) > REMEMBERED:
            self.forget()
        at = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list({pieces[i]: None for i in unknown}))
            at[unknown] = [self.index[pieces[i]] for i in unknown]
        sizes = self.length[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.start[at] - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.cumsum([len(c) for c in cut])]
        return np.split(flat, bounds[:-1])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder: what a worker learnt in one task serves the next."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ---- the code ---------------------------------------------------------------

_LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_SHIFTS = np.array([1, 4, 16, 64], np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    r = ranks.astype("<u4")
    n = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[:len(r)] = n - 1
    control = (codes.reshape(-1, 4) * _SHIFTS).sum(1, dtype=np.uint8)
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) < n[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    if (ends[-1] if n else 0) != len(data):
        raise ValueError(f"control bytes ask for {ends[-1] if n else 0} data bytes, {len(data)} are there")
    d = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    s = ends - lengths
    return (d[s] | d[s + 1] << 8 | d[s + 2] << 16 | d[s + 3] << 24) & _MASKS[lengths]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


# ---- Spark ------------------------------------------------------------------

def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, 16 bits each while the vocabulary
    allows, the end id last)."""
    def run(batches):
        enc = encoder(tokenizer)
        kind = np.dtype("<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        for b in batches:
            for s in byte_slices(b, text_col):
                ids = [np.append(x, END_ID).astype(kind) for x in enc.encode([t or "" for t in s[text_col].to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [s[id_col].cast(pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([kind.itemsize] * len(ids), pa.int32())],
                    ["doc_id", "n_tokens", "ids", "width"])
    return docs.select(id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, width int")


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if width == 2 else "<u4")


def frequencies(raw: DataFrame) -> DataFrame:
    """id, n over all documents; each task sends one row per id it saw."""
    def count(batches):
        n = np.zeros(1 << 16, np.int64)
        for b in batches:
            for x, w in zip(b["ids"], b["width"], strict=True):
                got = np.bincount(_ids(x.as_py(), w.as_py()), minlength=len(n))
                if len(got) > len(n):
                    n = np.concatenate([n, np.zeros(len(got) - len(n), np.int64)])
                n += got
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], ["id", "n"])
    return raw.select("ids", "width").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, part_ids: int = PART_IDS, **cols) -> None:
    """Encode ``docs`` and write a file set at ``path``."""
    spark = docs.sparkSession
    staged = scratch_path(spark, "token-ids")
    encoded(docs, tokenizer, **cols).write.option("compression", "zstd").parquet(staged)
    raw = spark.read.schema("doc_id long, n_tokens long, ids binary, width int").parquet(staged)
    # a row per id of the vocabulary: bounded by the tokenizer, not by the data
    counts = frequencies(raw).toPandas().sort_values(["n", "id"], ascending=[False, True])
    by_rank = counts["id"].to_numpy(np.int64)
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    counts.insert(0, "rank", np.arange(len(counts)))
    (spark.createDataFrame(counts, "rank long, id long, n long").coalesce(1).sortWithinPartitions("rank")
     .write.option("compression", "zstd").parquet(f"{path}/vocabulary"))
    parts = max(1, -(-int(counts["n"].sum()) // part_ids))
    cuts = raw.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20 * parts + 1000).alias("c")).first().c
    cuts = np.array(sorted(set(cuts or ())) if parts > 1 else [], np.int64)

    def code(b: pa.RecordBatch):
        for lo in range(0, b.num_rows, 500):
            s = b.slice(lo, 500)
            ids = [_ids(x.as_py(), w.as_py()) for x, w in zip(s["ids"], s["width"], strict=True)]
            packed = [pack(rank[x]) for x in ids]
            # null ids sort first
            part = np.where(s["doc_id"].is_null().to_numpy(zero_copy_only=False), 0,
                            np.searchsorted(cuts, s["doc_id"].fill_null(0).to_numpy(), "right"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), s["doc_id"], s["n_tokens"], pa.array([c for c, _ in packed], pa.binary()),
                 pa.array([d for _, d in packed], pa.binary()), pa.array([crc32(x) for x in ids], pa.int64())],
                ["part", "doc_id", "n_tokens", "control", "data", "ids_crc32"])
    (arrow_map(raw, code, "part int, doc_id long, n_tokens long, control binary, data binary, ids_crc32 long")
     .repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "doc_id", "n_tokens", "ids_crc32")
     .write.partitionBy("part").option("compression", "zstd").parquet(f"{path}/tokens"))


_STORED = "doc_id long, n_tokens long, control binary, data binary, ids_crc32 long, part int"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """part, doc_id, n_tokens, ids (array of int) of every stored document;
    raises if a document's ids differ from its checksum."""
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)

    def decode(b: pa.RecordBatch):
        for lo in range(0, b.num_rows, 200):
            s = b.slice(lo, 200)
            ids = [vocabulary[unpack(c.as_py(), d.as_py(), n.as_py())]
                   for c, d, n in zip(s["control"], s["data"], s["n_tokens"], strict=True)]
            got = [crc32(x) for x in ids]
            if got != s["ids_crc32"].to_pylist():
                raise ValueError("stored ids differ from their checksum")
            off = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [s["part"], s["doc_id"], s["n_tokens"], pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat)),
                 pa.array(got, pa.int64())], ["part", "doc_id", "n_tokens", "ids", "ids_crc32"])
    stored = spark.read.schema(_STORED).parquet(f"{path}/tokens")
    return arrow_map(stored, decode, "part int, doc_id long, n_tokens long, ids array<int>, ids_crc32 long")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """part, doc_id, n_tokens, ids_crc32 of the decoded ids; only digests leave
    the decoding tasks."""
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)

    def decode(b: pa.RecordBatch):
        got = [crc32(vocabulary[unpack(c.as_py(), d.as_py(), n.as_py())])
               for c, d, n in zip(b["control"], b["data"], b["n_tokens"], strict=True)]
        yield pa.RecordBatch.from_arrays([b["part"], b["doc_id"], b["n_tokens"], pa.array(got, pa.int64())],
                                         ["part", "doc_id", "n_tokens", "ids_crc32"])
    stored = spark.read.schema(_STORED).parquet(f"{path}/tokens")
    return arrow_map(stored, decode, "part int, doc_id long, n_tokens long, ids_crc32 long")


def layout(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: where each document starts in the
    file set.  Parts are summed first, so no window spans more than a part."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    inside = (Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
            .select("doc_id", (F.col("part_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"))
