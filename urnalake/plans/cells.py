"""Rollup cells kept per year, so that a report aggregates only years that changed.

A year of silver is reduced to a few dozen rows of mergeable measures. They are as good as the
year itself for the national, regional and state rollups, whatever years a report asks for.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.operators import audit, rollups
from urnalake.plans.lake import Lake
from urnalake.plans.reports import Report, report_of_rollups
from urnalake.plans.years import run_years
from urnalake.sources import audit_log, tables

DATASET = f"{S.SILVER_DATASET}_cells"


def refresh_year(spark: SparkSession, lake: Lake, year: int) -> int:
    """Make one year's cells again from its silver rows, which are all that is read; number of cells."""
    start = datetime.now(UTC)
    try:
        cells = rollups.stored_cells(tables.read_years(spark, lake.silver, [year])).drop("Ano")
        rows = F.coalesce(F.sum("rate_count"), F.lit(0))
        figures = tables.write_year(cells.coalesce(1), lake.cells, year, {"silver_rows": rows})
    except Exception as error:
        failure = audit_log.silver_failure(spark, DATASET, year, start, datetime.now(UTC), str(error))
        audit_log.append(failure, lake.silver_log)
        raise
    success = audit_log.silver_success(
        spark, DATASET, year, start, datetime.now(UTC), figures["silver_rows"], figures["rows"]
    )
    audit_log.append(success, lake.silver_log)
    return figures["rows"]


def refresh(spark: SparkSession, lake: Lake, years: list[int]) -> list[int]:
    """Make the cells of years that have none, or whose silver rows changed since; returns those years.

    A silver year changed if a build of it succeeded after its cells were begun, as the audit log
    tells it. Files of other years are not opened.
    """
    manifest = tables.years_frame(spark, years).select(F.lit(DATASET).alias("dataset"), "ano")
    log = audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA)
    work = audit.pending_silver(
        manifest,
        log,
        silver_years=tables.years_frame(spark, tables.years_in(spark, lake.cells)),
        bronze_years=tables.years_frame(spark, tables.years_in(spark, lake.silver)),
        bronze_log=log.where(F.col("dataset") == S.SILVER_DATASET),
    )
    pending = sorted(row["ano"] for row in work.collect())
    run_years(lambda year: refresh_year(spark, lake, year), pending)
    return pending


def report(spark: SparkSession, lake: Lake, years: list[int], **options) -> Report:
    """The report of :func:`urnalake.plans.report` from cells, which are brought up to date first.

    A year that has lost its silver data since has no rows in the report, whatever cells it has.
    """
    refresh(spark, lake, years)
    present = sorted(set(years) & set(tables.years_in(spark, lake.silver)))
    cells = tables.read_years(spark, lake.cells, present, S.CELL_SCHEMA)
    return report_of_rollups(rollups.rollups_of_cells(cells), years, **options)
