import gzip
import hashlib
import io

import pytest
from brute import sha

from urnalake.llm import warc
from urnalake.llm.common import written
from urnalake.session import scratch_folder

PAGES = [
    (1, "http://a/", "x" * 100), (2, "http://b/ü \r\nEvil: 1", "x" * 100), (3, None, "x" * 99), (4, "http://d/", "x" * 99),
    (5, "u", None), (6, "u", ""), (7, "u", "é" * 50), (8, "u", "é" * 50), (None, "u", "x" * 100), (9, "big", "WARC/1.1\r\n" * 90_000),
    (10, "u", "a\r\n\r\nb" * 30), (1, "http://a/", "x" * 100),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


def expected(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        first = min((k for k, _, h in rows if k is not None and (h or "").encode() == data), default=None)
        again = len(data) >= 100 and first is not None and key != first
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_written_and_read_back(spark):
    assert sorted(map(tuple, warc.archived(frame(spark, PAGES)).collect()), key=str) == expected(PAGES)


def test_empty_table(spark):
    assert warc.archived(frame(spark, PAGES).limit(0)).collect() == []


def test_chunks_carry_content_and_incremental_digests(spark):
    folder = scratch_folder(spark, "warc-test")
    index = written(warc.write_archives(warc.with_revisits(frame(spark, PAGES)), folder), "warc-test-index")
    rows = warc.read_chunks(index).collect()
    by_record = {}
    for r in sorted(rows, key=lambda r: (r["archive"], r["record"], r["chunk"])):
        by_record.setdefault((r["archive"], r["record"]), []).append(r)
    texts = {k: h or "" for k, _, h in PAGES}
    for parts in by_record.values():
        assert [p["chunk"] for p in parts] == list(range(len(parts)))
        seen = b""
        for p in parts:
            assert p["n_bytes"] == len(p["data"]) <= warc.CHUNK_BYTES
            seen += bytes(p["data"])
            assert p["digest"] == hashlib.sha256(seen).hexdigest()
        key = int(parts[0]["record_id"]) if parts[0]["record_id"] else None
        assert seen.decode() == ("" if parts[0]["record_type"] == "revisit" else texts[key])
        assert parts[0]["stated_digest"] == sha(texts[key])
    assert max(map(len, by_record.values())) == 4
    assert sum(r["records"] for r in index.collect()) == len(PAGES)


def test_archives_are_plain_warc(spark):
    folder = scratch_folder(spark, "warc-test")
    index = written(warc.write_archives(warc.with_revisits(frame(spark, PAGES[:2]).coalesce(1)), folder), "warc-test-index")
    with gzip.open(index.first()["archive"].removeprefix("file:")) as file:
        content = file.read()
    assert content.count(b"WARC/1.1\r\nWARC-Type: ") == 2
    assert b"\r\nEvil" not in content and content.endswith(b"\r\n\r\n")


def test_damage_is_noticed():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\n"
    with pytest.raises(ValueError, match="ends early"):
        list(warc.chunks_of(io.BytesIO(head + b"short")))
    with pytest.raises(ValueError, match="no record"):
        list(warc.chunks_of(io.BytesIO(b"junk\r\n")))
