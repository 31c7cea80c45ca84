"""Bronze to silver, one audited map-only job per pending year."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.functions.casting import quoted
from urnalake.operators import audit
from urnalake.operators.quality import require_schema
from urnalake.operators.silver import to_silver
from urnalake.operators.union import unite
from urnalake.plans.lake import Lake
from urnalake.plans.years import run_years
from urnalake.sources import audit_log, tables


def silver_frame(bronze: DataFrame) -> DataFrame:
    """What the job writes for a year's bronze rows."""
    silver = to_silver(bronze)
    require_schema(silver)
    return silver


def build_silver_year(spark: SparkSession, lake: Lake, year: int) -> tuple[int, int]:
    """(rows before, rows after) the null removal.

    Rows before come from the bronze files' footers, rows after are counted by the write. No
    count stands between the null filter and the scan, so the filter reaches the scan.
    """
    start = datetime.now(UTC)
    try:
        parts = tables.year_parts(spark, lake.bronze, year)
        bronze = unite(parts)
        rows_before = bronze.count()
        # A column that a part of the year was never loaded with is no reason to remove its rows.
        silver = unite([silver_frame(part) for part in parts])
        silver = silver.select(*map(quoted, [*bronze.columns, *(c for c in silver.columns if c not in bronze.columns)]))
        rows_after = tables.write_year(silver, lake.silver, year)["rows"]
    except Exception as error:
        failure = audit_log.silver_failure(
            spark, S.SILVER_DATASET, year, start, datetime.now(UTC), str(error)
        )
        audit_log.append(failure, lake.silver_log)
        raise
    success = audit_log.silver_success(
        spark, S.SILVER_DATASET, year, start, datetime.now(UTC), rows_before, rows_after
    )
    audit_log.append(success, lake.silver_log)
    return rows_before, rows_after


def build_silver(spark: SparkSession, lake: Lake, years: list[int]) -> list[int]:
    """Build the years that have bronze data and are not finished; returns the years built.

    A year whose bronze rows changed after its build began is not finished.
    A year without bronze data is passed over and leaves no audit row.
    """
    manifest = tables.years_frame(spark, years).select(F.lit(S.SILVER_DATASET).alias("dataset"), "ano")
    log = audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA)
    bronze_log = audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA)
    work = audit.pending_silver(
        manifest,
        log,
        silver_years=tables.years_frame(spark, tables.years_in(spark, lake.silver)),
        bronze_years=tables.years_frame(spark, tables.years_in(spark, lake.bronze)),
        bronze_log=bronze_log.where(F.col("dataset") == S.BRONZE_DATASET),
    )
    pending = sorted(row["ano"] for row in work.collect())
    run_years(lambda year: build_silver_year(spark, lake, year), pending)
    return pending
