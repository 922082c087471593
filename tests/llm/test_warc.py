import base64
import hashlib
import io
import struct
from pathlib import Path

import pytest
import zstandard

from strata.llm import warc_bundles
from strata.plans.session import scratch_path

PAGES = "page_id long, url string, html string, sha1 string, response int"  # the last two clash with names of the operator


def page(i, html, url="http://a.org/x"):
    return (i, url, html, "clash", 0)


ROWS = [
    page(1, "<p>one</p>"), page(2, "<p>one</p>", None), page(3, "<p>two ü</p>"), page(7, "<p>one</p>", "http://b.org/a b\r\nX: 1"),
    page(4, None), page(5, ""), page(5, ""), page(None, "alone"), page(None, "<p>two ü</p>"), page(6, "x" * 700_000), page(8, "a\r\n\r\nWARC/1.1"),
]


def made(spark, rows, **options):
    path = scratch_path(spark, "test-warc")
    warc_bundles.archive(spark.createDataFrame(rows, PAGES).repartition(2), path, **options)
    return path


def expected(rows, least=0):
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        top = max(same, default=None) if len(data) >= least else None
        again = top is not None and i != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5, 100])
def test_records_read_back(spark, least):
    got = warc_bundles.records(spark, made(spark, ROWS, least_bytes=least))
    rows = [(r.id and int(r.id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in got.collect()]
    assert sorted(rows, key=repr) == expected(ROWS, least)


def test_payloads_and_urls(spark):
    got = warc_bundles.records(spark, made(spark, ROWS), payloads=True).collect()
    assert {(r.id, bytes(r.payload).decode()) for r in got if r.record_type == "response"} == {
        (None if i is None else str(i), html or "") for i, _, html, *_ in ROWS if not (html == "<p>one</p>" and i != 7) and (i, html) not in ((4, None), (None, "<p>two ü</p>"))
    }
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert {r.id: r.url for r in got}["7"] == "http://b.org/a%20b%0D%0AX:%201" and {r.id: r.url for r in got}["2"] is None


def test_bundles_follow_the_formats(spark, monkeypatch):
    monkeypatch.setattr(warc_bundles, "FRAME_BYTES", 800)
    path = made(spark, ROWS * 3)
    n = 0
    for f in Path(path.removeprefix("file:")).glob("part-*"):
        data = f.read_bytes()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        n += plain.count(b"WARC-Record-ID: ")
        assert plain.startswith(b"WARC/1.1\r\n")
        frames, flags, magic = struct.unpack("<IBI", data[-9:])
        assert magic == 0x8F92EAB1 and flags == 0
        sizes = [struct.unpack_from("<II", data, len(data) - 9 - 8 * (frames - k)) for k in range(frames)]
        assert struct.unpack_from("<II", data, len(data) - 9 - 8 * frames - 8) == (0x184D2A5E, 8 * frames + 9)
        assert sum(s for _, s in sizes) == len(plain) and sum(s for s, _ in sizes) + 8 * frames + 17 == len(data)
        assert frames > 2
        at = 0
        for size, full in sizes[:-1]:  # each frame stands by itself
            assert len(zstandard.ZstdDecompressor().decompress(data[at : at + size])) == full
            at += size
    assert n == len(ROWS * 3)


def test_index_and_fetch(spark):
    path = made(spark, ROWS)
    entries, records = warc_bundles.index(spark, path), warc_bundles.records(spark, path, payloads=True)
    assert entries.count() == len(ROWS)
    whole = {r.record_id: r for r in records.collect()}
    for r in warc_bundles.fetch(spark, entries).collect():
        assert r == whole[r.record_id]
    one = next(r for r in whole.values() if r.id == "6")
    assert warc_bundles.fetch(spark, entries.where(entries.record_id == one.record_id)).collect() == [one]
    assert warc_bundles.fetch(spark, entries.limit(0)).count() == 0


def test_no_rows_and_a_broken_file(spark, tmp_path):
    path = made(spark, ROWS[:1])
    assert warc_bundles.records(spark, made(spark, [])).count() == 0
    f = next(f for f in Path(path.removeprefix("file:")).glob("part-*") if f.stat().st_size)
    (tmp_path / "cut").write_bytes(f.read_bytes()[:-3])
    with pytest.raises(Exception, match="seek table is missing"):
        warc_bundles.records(spark, str(tmp_path)).collect()


