import gzip
import hashlib
from base64 import b32encode

import pytest

from kollektiv.llm import warc
from kollektiv.llm.common import scratch_path

PAGES = [(3, "http://a.example/x y", "<p>one</p>"), (1, None, "<p>one</p>"), (2, "http://b/é", None), (7, "http://c", ""), (5, "u\n", "WARC/1.0\r\n\r\nfoo"),
         (None, "http://n", "<p>one</p>"), (9, "http://l", "longé" * 60_000), (4, "http://d", "a\r\n\r\nb\n"), (4, "http://d", "a\r\n\r\nb\n")]


def brute(pages):
    groups = {}
    for pid, _, html in pages:
        groups.setdefault((html or "").encode(), []).append(pid)
    out = []
    for payload, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        at = ids.index(first)
        out += [(i, len(payload), b32encode(hashlib.sha1(payload).digest()).decode(), "response" if k == at else "revisit",
                 None if k == at else first) for k, i in enumerate(ids)]
    return sorted(map(str, out))


def frame(spark, pages):
    return spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, payload_bytes int, archive string")


def test_pages_come_back(spark):
    got = warc.pages_through_warc(frame(spark, PAGES).repartition(3)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(PAGES)


def test_payloads_below_the_limit_are_all_stored(spark):
    got = {r.page_id: r.record_type for r in warc.pages_through_warc(frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "yy"), (4, "d", "yy")]), 2).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert warc.pages_through_warc(frame(spark, [])).count() == 0


def test_warc_files_hold_what_the_format_asks_for(spark):
    arc, out = scratch_path(spark, "t-arc"), scratch_path(spark, "t-warc")
    warc.write_archives(warc.arc_rows(frame(spark, PAGES).coalesce(1)), arc, "\n")
    warc.convert(spark, arc, out)
    raws = [r.content for r in warc.archives(spark, out).collect()]
    records = [x for raw in raws for x in warc.warc_records(raw)]
    assert [h["warc-type"] for h, _ in records].count("warcinfo") == len(raws)
    pages = [(h, b) for h, b in records if h["warc-type"] != "warcinfo"]
    assert len(pages) == len(PAGES) and len({h["warc-record-id"] for h, _ in records}) == len(records)
    for h, block in pages:
        assert h["warc-date"].startswith("2024-01-01T00:00:0") and int(h["content-length"]) == len(block)
        assert h["warc-block-digest"] == "sha1:" + warc.sha1_base32(block)
        if h["warc-type"] == "revisit":
            assert h["warc-refers-to"] in {x["warc-record-id"] for x, _ in pages} and block.endswith(b"\r\n\r\n")
    for raw in raws:
        assert gzip.decompress(raw).startswith(b"WARC/1.0\r\nWARC-Type: warcinfo")


_ABOUT = b"1 0 Origin\nURL IP-address Archive-date Content-type Archive-length\n"
V1 = (b"filedesc://x.arc 0.0.0.0 20240101000000 text/plain %d\n%s\n" % (len(_ABOUT), _ABOUT)
      + b"http://a/ 1.2.3.4 20240102030405 text/html 5\nab\ncd\n")
V2 = (b"filedesc://x.arc 0.0.0.0 20240101000000 text/plain 200 - - 0 x.arc 13\n2 0 Origin\nU\n\n"
      b"http://b/ 1.2.3.4 20240102030405 text/html 404 - - 99 x.arc 3\nxyz\n")


@pytest.mark.parametrize("wrap", [bytes, gzip.compress])
def test_both_versions_are_read_by_declared_length(wrap):
    (a,) = warc.arc_records(wrap(V1))
    assert (a["version"], a["url"], a["block"], a["status"]) == (1, b"http://a/", b"ab\ncd", None)
    (b,) = warc.arc_records(wrap(V2))
    assert (b["version"], b["url"], b["block"], b["status"]) == (2, b"http://b/", b"xyz", b"404")


@pytest.mark.parametrize("raw", [V1[:-4], b"http://a/ 1.2.3.4 20240102030405 text/html\nab\n", b"a b c d 5x\nabcde\n", b"a b c d 3",
                                 b"filedesc://x 0.0.0.0 2024 text/plain 3\n9 0\n"])
def test_damaged_archives_raise(raw):
    with pytest.raises(warc.ArchiveError):
        list(warc.arc_records(raw))


def test_members_of_a_gzip_file_are_read_on():
    both = gzip.compress(V1) + gzip.compress(V2)
    assert [r["url"] for r in warc.arc_records(both)] == [b"http://a/", b"http://b/"]
