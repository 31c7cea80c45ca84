"""WARC archives, written from a table and read back as a table of record chunks.

A record of any size is read as rows of (record, chunk number) of bounded size. Each carries the
digest of the payload up to and including it, so the last one has the record's digest and no
step holds a whole record.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table, written
from urnalake.session import scratch_folder
from urnalake.sources.files import open_filesystem, qualified

#: Bytes of payload in a chunk row.
CHUNK_BYTES = 1 << 18
#: Payload bytes after which a task begins a new archive.
ARCHIVE_BYTES = 1 << 28
#: Payloads from this size on are written once; equal ones refer to it.
REVISIT_FROM = 100
#: The crawl time is not part of the input.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = (
    "archive string, record long, record_id string, record_type string, uri string, refers_to string,"
    " stated_bytes long, stated_digest string, chunk int, n_bytes int, digest string, data binary"
)


def with_revisits(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, url, html, n_bytes, digest, refers_to): which record has an equal payload already.

    Of equal payloads of at least REVISIT_FROM bytes the one with the smallest key stays, the
    others refer to it; null keys come last, rows that share the smallest key all stay.
    """
    html = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.col("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("n_bytes"), F.sha2(html.cast("binary"), 256).alias("digest"),
    )
    first = (
        rows.where(F.col("n_bytes") >= REVISIT_FROM).groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    other = ~F.col("key").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "key", "url", "html", "n_bytes", "digest", F.when(other, F.col("first")).alias("refers_to")
    )


def _record_id(key) -> str:
    return f"<urn:record:{'' if key is None else quote(str(key), safe='')}>"


def _head(key, url, n_bytes: int, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "about:blank", safe="%/:?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", str(n_bytes)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + (0 if revisit else n_bytes))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    return b"WARC/1.1\r\n" + b"".join(f"{a}: {b}\r\n".encode() for a, b in fields) + b"\r\n" + http


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes what :func:`with_revisits` gives as archives; (archive, records), one row for each.

    A task writes below names of its own and reports them at its end. Only reported archives
    count, so a retried or doubled task leaves files that nobody reads. Each record is a gzip
    member, written a slice at a time.
    """
    ship(records.sparkSession)
    folder = qualified(records.sparkSession, folder)

    def run(batches):
        filesystem, inside = open_filesystem(folder)
        filesystem.create_dir(inside, recursive=True)
        out, names, counts, size = None, [], [], 0
        try:
            for batch in batches:
                columns = (batch.column(c) for c in ("key", "url", "html", "n_bytes", "digest", "refers_to"))
                for row in zip(*columns, strict=True):
                    key, url, html, n_bytes, digest, refers_to = (value.as_py() for value in row)
                    if out is None or size >= ARCHIVE_BYTES:
                        if out:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, size = filesystem.open_output_stream(f"{inside}/{name}", compression=None), 0
                        names.append(name)
                        counts.append(0)
                    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=4, mtime=0) as member:
                        member.write(_head(key, url, n_bytes, digest, refers_to))
                        if refers_to is None:
                            for begin in range(0, len(html), CHUNK_BYTES):
                                member.write(html[begin : begin + CHUNK_BYTES].encode("utf-8"))
                            size += n_bytes
                        member.write(b"\r\n\r\n")
                    counts[-1] += 1
        finally:
            if out:
                out.close()
        if names:
            paths = [f"{folder}/{name}" for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], names=["archive", "records"])

    return records.mapInArrow(run, "archive string, records long")


def _fields(stream: BinaryIO) -> dict[str, str]:
    fields = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _bare(record_id: str | None) -> str | None:
    return None if record_id is None else unquote(record_id.removeprefix("<urn:record:").removesuffix(">"))


def chunks_of(stream: BinaryIO) -> Iterator[dict]:
    """The records of an open archive as chunks, read in order and never further than a chunk."""
    record = -1
    while (line := stream.readline()):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        record += 1
        fields = _fields(stream)
        left = int(fields["content-length"])
        if fields.get("content-type", "").startswith("application/http"):
            while (line := stream.readline()) and left > 0:
                left -= len(line)
                if not line.strip():
                    break
        digest, chunk = hashlib.sha256(), 0
        while left > 0 or not chunk:
            data = stream.read(min(CHUNK_BYTES, left))
            if len(data) < min(CHUNK_BYTES, left):
                raise ValueError(f"record {fields.get('warc-record-id')} ends early")
            left -= len(data)
            digest.update(data)
            yield {
                "record": record, "record_id": _bare(fields.get("warc-record-id")), "record_type": fields.get("warc-type"),
                "uri": fields.get("warc-target-uri"), "refers_to": _bare(fields.get("warc-refers-to")),
                "stated_bytes": int(fields["warc-payload-length"]) if "warc-payload-length" in fields else None,
                "stated_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                "chunk": chunk, "n_bytes": len(data), "digest": digest.hexdigest(), "data": data,
            }
            chunk += 1


def read_chunks(archives: DataFrame) -> DataFrame:
    """The chunk table of the archives named in column ``archive``; an archive is one task's."""
    spark = archives.sparkSession
    ship(spark)
    names = [part.split()[0] for part in _CHUNKS.split(",")]

    def run(batches):
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                filesystem, inside = open_filesystem(archive)
                with filesystem.open_input_file(inside) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    held, size = [], 0
                    for row in chunks_of(stream):
                        held.append(row | {"archive": archive})
                        size += row["n_bytes"] + 500
                        if size >= 4 * CHUNK_BYTES:
                            yield _batch(held, names)
                            held, size = [], 0
                    if held:
                        yield _batch(held, names)

    spread = archives.select("archive").repartition(2 * spark.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, _CHUNKS)


_KINDS = {"record": pa.int64(), "stated_bytes": pa.int64(), "chunk": pa.int32(), "n_bytes": pa.int32(), "data": pa.binary()}


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], _KINDS.get(n, pa.string())) for n in names], names=names
    )


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record; size and digest of responses come from their chunks.

    A revisit has no payload of its own: its size and digest are those it states. ``sound`` is
    false where a response's chunks disagree with what it states.
    """
    whole = chunks.groupBy("archive", "record").agg(
        F.first("record_id").alias("record_id"), F.first("record_type").alias("record_type"),
        F.first("uri").alias("uri"), F.first("refers_to").alias("refers_to"),
        F.first("stated_bytes").alias("stated_bytes"), F.first("stated_digest").alias("stated_digest"),
        F.sum("n_bytes").alias("read_bytes"), F.max_by("digest", "chunk").alias("read_digest"),
    )
    revisit = F.col("record_type") == "revisit"
    same = (F.col("read_bytes") == F.col("stated_bytes")) & (F.col("read_digest") == F.col("stated_digest"))
    return whole.select(
        "record_id", "record_type", "uri", "refers_to",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("read_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("read_digest")).alias("payload_digest"),
        (revisit | same).alias("sound"),
    )


def archived(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) after writing and reading back.

    Null html is an empty payload; null keys come back as null; repeated rows are a record each;
    an empty table writes no archive and gives no rows; columns other than key, ``url`` and html
    are not written. Archives go to the shared scratch folder.
    """
    spark = pages.sparkSession
    records = with_revisits(pages, key, html)
    index = written(write_archives(records, scratch_folder(spark, "warc")), "warc-index")
    kind = pages.schema[key].dataType
    back = records_of(read_chunks(index))
    unsound = F.raise_error(F.concat(F.lit("damaged record "), "record_id")).cast("long")
    return back.select(
        F.when(F.col("record_id") != "", F.col("record_id")).cast(kind).alias(key),
        F.when(F.col("sound"), F.col("payload_bytes")).otherwise(unsound).alias("payload_bytes"),
        "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )


SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


@check(SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))
