from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from hypothesis import given, strategies as st

from ledgerline.llm import warc as W

PAGES = "page_id long, url string, html string, payload string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], PAGES).repartition(3)


def brute(rows, min_bytes=0):
    out, groups = [], {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    for payload, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known, default=None)
        answered = False
        for i in ids:
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            first = len(payload) < min_bytes or best is None or (i == best and not answered)
            answered = answered or i == best
            out.append((i, len(payload), digest, "response" if first else "revisit", None if first else best))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def rows_of(prose):
    rows = [(i, f"http://x/{i}", f"<p>{prose(i, 40)}</p>") for i in range(60)]
    rows += [(100 + i, f"http://y/{i}", "<p>the same</p>") for i in range(40)]
    rows += [(200, None, None), (201, "http://z", ""), (202, "bad url\r\nX: y", "WARC/1.1\r\n\r\n\x1f"),
             (None, "u", "<p>the same</p>"), (None, "u", "nobody"), (None, "u", "nobody"),
             (7, "http://x/7", f"<p>{prose(7, 40)}</p>"), (-3, "neg", "x"), (-(1 << 63) + 1, "low", "x"),
             ((1 << 63) - 1, "high", "y" * 300_000)]
    return rows


@pytest.mark.parametrize("min_bytes", [0, 20])
@pytest.mark.parametrize("split", [97, 1 << 24])
def test_round_trip_equals_brute_force(spark, prose, min_bytes, split):
    rows = rows_of(prose)
    manifest = W.write_archives(pages_of(spark, rows), min_bytes, file_bytes=4000)
    got = W.read_archives(manifest, split)
    result = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
              for r in got.collect()]
    assert sorted(result, key=lambda r: tuple((x is not None, x) for x in r)) == brute(rows, min_bytes)
    payload = {r["page_id"]: r["payload"] for r in got.where("record_type = 'response'").collect()}
    for i, _, html in rows:
        if i is not None and i in payload:
            assert bytes(payload[i]) == (html or "").encode()
    assert got.select("path", "offset").distinct().count() == len(rows)


def test_files_are_plain_gzip(spark, prose):
    part = W.write_archives(pages_of(spark, rows_of(prose)[:5])).collect()
    for p in part:
        local = p["path"].removeprefix("file://")
        assert os.path.getsize(local) == p["bytes"]
        text = gzip.open(local).read()
        assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Type: response") <= p["records"]


def window_of(data: bytes, ahead: int = 50) -> W.ByteWindow:
    class Source(io.BytesIO):
        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)
    return W.ByteWindow(Source(data), len(data), ahead)


def archive(n: int = 30, level: int = 6):
    rng = random.Random(n)
    records = [W.build_record(i, f"u{i}", bytes(rng.choices(b"ab\x1f\x8b\x08 ", k=rng.randrange(400))))
               for i in range(n)]
    # a payload that is itself an archive, stored as it is
    inner = b"".join(zlib.compress(r, 6, 31) for r in records[:3])
    records.insert(4, W.build_record(99, "nested", inner))
    return records, [W.gzip_member(r, 0 if b"nested" in r[:300] else level) for r in records]


def test_every_split_reads_each_record_once():
    records, parts = archive()
    data = b"".join(parts)
    whole = list(W.members(window_of(data), 0, len(data)))
    assert [d for _, d in whole] == records
    for step in (1, 61, 333, 5000):
        got = [x for a in range(0, len(data), step)
               for x in W.members(window_of(data), a, min(a + step, len(data)))]
        assert got == whole


def test_a_damaged_member_is_passed_over():
    records, parts = archive()
    broken = bytearray(parts[10])
    broken[len(broken) // 2] ^= 0xFF
    data = b"".join([*parts[:10], bytes(broken), *parts[11:]])
    got = [d for _, d in W.members(window_of(data), 0, len(data))]
    assert got == records[:10] + records[11:]


@given(st.one_of(st.none(), st.integers(-(1 << 63), (1 << 63) - 1)), st.integers(0, 1 << 31))
def test_record_ids(page, repeat):
    assert W.page_of(W.record_id(page, repeat)) == page


def test_empty_table(spark):
    manifest = W.write_archives(pages_of(spark, []).where("false"))
    assert manifest.count() == 0 and W.read_archives(manifest).count() == 0
