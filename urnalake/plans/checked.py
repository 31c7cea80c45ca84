"""Value rules enforced: rows that keep them go to the table, the others to quarantine, in one pass.

    <root>/layer=table/year=<year>/       rows that keep all rules
    <root>/layer=quarantine/year=<year>/  rows that break one or more, with the rules they break

Each layer is a year-partitioned table of its own for the readers of :mod:`urnalake.sources.tables`.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.operators.quality import broken_rules
from urnalake.plans.lake import Lake
from urnalake.plans.years import run_years
from urnalake.sources import audit_log, tables
from urnalake.sources.files import hadoop_path

TABLE, QUARANTINE = "table", "quarantine"
#: Column of the rules that a row breaks; NULL in the table.
REASONS = "_regras_violadas"


def layer(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/layer={name}"


def write_checked_year(df: DataFrame, root: str, year: int, rules: list[S.Rule]) -> tuple[int, int]:
    """Replace one year of both layers by the rows of ``df``; (rows in the table, in quarantine).

    One write and one scan: the layer is a partition column. A NULL breaks no rule. Every row is in
    one of the layers, and a layer without rows has no such year afterwards.
    """
    spark = df.sparkSession
    reasons = broken_rules(rules)
    routed = df.withColumn(REASONS, F.when(F.size(reasons) > 0, reasons)).withColumn(
        "layer", F.when(F.col(REASONS).isNull(), TABLE).otherwise(QUARANTINE)
    )
    seen = Observation()
    counts = [F.count_if(F.col("layer") == name).alias(name) for name in (TABLE, QUARANTINE)]
    (
        routed.observe(seen, *counts).withColumn("year", F.lit(year))
        .write.mode("overwrite")
        .options(**tables.PARQUET_OPTIONS, partitionOverwriteMode="dynamic")
        .partitionBy("layer", "year")
        .parquet(root)
    )
    figures = seen.get
    for name in (TABLE, QUARANTINE):
        if not figures[name]:  # dynamic overwrite leaves what an earlier load put there
            filesystem, folder = hadoop_path(spark, f"{layer(root, name)}/year={year}")
            filesystem.delete(folder, True)
    return figures[TABLE], figures[QUARANTINE]


def check_silver_year(spark: SparkSession, lake: Lake, year: int, rules: list[S.Rule] | None = None) -> tuple[int, int]:
    """Check one silver year; its audit row has all rows as before and the table's as after."""
    start = datetime.now(UTC)
    dataset = f"{S.SILVER_DATASET}_checked"
    try:
        silver = tables.read_year(spark, lake.silver, year)
        kept, rejected = write_checked_year(silver, lake.checked, year, S.silver_rules() if rules is None else rules)
    except Exception as error:
        audit_log.append(audit_log.silver_failure(spark, dataset, year, start, datetime.now(UTC), str(error)), lake.silver_log)
        raise
    success = audit_log.silver_success(spark, dataset, year, start, datetime.now(UTC), kept + rejected, kept)
    audit_log.append(success, lake.silver_log)
    return kept, rejected


def check_silver(spark: SparkSession, lake: Lake, years: list[int], rules: list[S.Rule] | None = None) -> None:
    """Check the silver years that are there."""
    present = [y for y in years if y in set(tables.years_in(spark, lake.silver))]
    run_years(lambda year: check_silver_year(spark, lake, year, rules), present)
