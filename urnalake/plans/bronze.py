"""Landed files to the bronze table, one audited job per pending year."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.operators import audit
from urnalake.operators.quality import require_contract
from urnalake.plans.lake import Lake
from urnalake.plans.years import run_years
from urnalake.sources import archives, audit_log, encodings, files, landed_csv, manifest, tables


@dataclass
class Loaded:
    """What a load reports to the audit log."""

    rows: int
    malformed: int
    size_bytes: int
    checksum: str
    encoding: str


def bronze_frame(
    spark: SparkSession,
    path: str,
    source: str,
    encoding: str | Mapping[str, Sequence[str]] = "UTF-8",
    input_bytes: int | None = None,
    malformed: Observation | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Typed bronze rows of landed CSV files. Map-only: no shuffle between file and table."""
    landed = landed_csv.read_landed(spark, path, encoding, malformed=malformed, multi_line=multi_line)
    require_contract(landed)
    if input_bytes is not None:
        landed = landed_csv.fewer_splits(landed, input_bytes)
    return landed_csv.with_lineage(landed_csv.typed(landed), source)


def _write(
    spark: SparkSession, lake: Lake, path: str, size_bytes: int, year: int, encoding: str, multi_line: bool
) -> tuple[int, int, str]:
    """(rows, malformed lines, encoding), the first two counted by the write itself.

    With :data:`encodings.PER_FILE` the files are judged first, in a pass of its own over their bytes.
    """
    source = f"{S.SOURCE_PREFIX}:{S.BRONZE_DATASET}:{year}"
    malformed = Observation()
    chosen = encodings.files_by_encoding(spark, [path]) if encoding == encodings.PER_FILE else encoding
    frame = bronze_frame(spark, path, source, chosen, size_bytes, malformed, multi_line)
    rows = tables.write_year(frame, lake.bronze, year)["rows"]
    return rows, malformed.get["malformed"], chosen if isinstance(chosen, str) else encodings.summary(chosen)


def _load_archives(
    spark: SparkSession, lake: Lake, origin: str, year: int, encoding: str, multi_line: bool
) -> Loaded:
    """Loads the largest CSV of every archive of an origin, each hashed while it is extracted.

    Each run lands in a folder of its own, so nothing of an earlier run is read.
    """
    found = files.list_files(spark, origin)
    folder = f"{lake.landing}/year={year}/{uuid.uuid4().hex}"
    landed = archives.land_archives(spark, found, folder).select("size_bytes", "sha256")
    whole = files.folder_digest(landed).first()
    rows, malformed, used = _write(spark, lake, folder, whole["size_bytes"], year, encoding, multi_line)
    return Loaded(rows, malformed, whole["size_bytes"], whole["sha256"], used)


def _load_files(
    spark: SparkSession, lake: Lake, origin: str, year: int, encoding: str, multi_line: bool
) -> Loaded:
    """Loads a CSV file or all files of a folder, nested ones too.

    A checksum is computed front to back, one file per task, while the load is split. Both
    run at the same time, so that one very large file does not hold up the load.
    """
    listed = files.list_files(spark, origin)
    size_bytes = listed.agg(F.sum("length")).first()[0] or 0
    with ThreadPoolExecutor(max_workers=1) as pool:
        digest = pool.submit(lambda: files.folder_digest(files.digests(listed)).first())
        rows, malformed, used = _write(spark, lake, origin, size_bytes, year, encoding, multi_line)
    return Loaded(rows, malformed, size_bytes, digest.result()["sha256"], used)


def ingest_year(
    spark: SparkSession, lake: Lake, year: int, origin: str, encoding: str = "UTF-8", multi_line: bool = False
) -> int:
    """Load one year. Data is written first, the audit row second; a failure is logged and raised."""
    start = datetime.now(UTC)
    load = _load_archives if origin.endswith(".zip") else _load_files
    try:
        if origin.startswith(("http://", "https://")):
            raise ValueError(f"{origin} is not on storage: land the file first, then give its path")
        done = load(spark, lake, origin, year, encoding, multi_line)
    except Exception as error:
        failure = audit_log.bronze_failure(
            spark, S.BRONZE_DATASET, year, start, datetime.now(UTC), str(error)
        )
        audit_log.append(failure, lake.bronze_log)
        raise
    success = audit_log.bronze_success(
        spark, S.BRONZE_DATASET, year, start, datetime.now(UTC),
        done.rows, done.size_bytes, done.checksum, done.malformed, encoding=done.encoding,
    )
    audit_log.append(success, lake.bronze_log)
    return done.rows


def ingest(
    spark: SparkSession, lake: Lake, origins: dict[int, str], encoding: str = "UTF-8", multi_line: bool = False
) -> list[int]:
    """Load every year of ``origins`` that has not succeeded before; returns the years loaded.

    The years are at most the thirty-one the manifest rule allows, and each is a Spark job
    of its own, as failure and audit are per year.
    """
    requested = spark.createDataFrame(
        [(S.BRONZE_DATASET, int(y), o) for y, o in origins.items()], "dataset string, ano int, origin string"
    )
    checked = manifest.with_validity(requested)
    invalid = checked.where("NOT is_valid").select("ano", "origin").collect()
    if invalid:
        raise ValueError(f"invalid manifest rows: {[tuple(r) for r in invalid]}")
    log = audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA)
    work = {row["ano"]: row["origin"] for row in audit.pending_bronze(requested, log).collect()}
    run_years(lambda year: ingest_year(spark, lake, year, work[year], encoding, multi_line), sorted(work))
    return sorted(work)
