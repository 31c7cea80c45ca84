"""Append-only audit logs stored beside the tables, never inside a table's folder."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.sources.files import path_exists


def read_log(spark: SparkSession, root: str, layout: T.StructType) -> DataFrame:
    """The whole log. Columns that older files lack are NULL."""
    if not path_exists(spark, root):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in layout])
    return spark.read.schema(layout).parquet(root)


def record(
    spark: SparkSession,
    layout: T.StructType,
    dataset: str,
    year: int,
    start: datetime,
    end: datetime,
    **values: object,
) -> DataFrame:
    """One log row without its run id; times are instants, the duration follows from them."""
    row = {
        "dataset": dataset,
        "ano": year,
        "timestamp_inicio": start.astimezone(UTC),
        "timestamp_fim": end.astimezone(UTC),
        "duracao_segundos": (end - start).total_seconds(),
        **values,
    }
    return spark.range(1, numPartitions=1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in layout if f.name != "run_id"]
    )


def append(row: DataFrame, root: str) -> None:
    """Add one row in a folder of its own, so that runs at the same time never share a commit.

    The folder name is the run id, which readers see as a column.
    """
    row.write.parquet(f"{root.rstrip('/')}/run_id={uuid.uuid4().hex}")


def bronze_success(
    spark, dataset, year, start, end, rows, size_bytes, checksum, malformed=None, kind=None, encoding=None
) -> DataFrame:
    return record(
        spark, S.BRONZE_AUDIT_SCHEMA, dataset, year, start, end,
        status=S.STATUS_OK, linhas=rows, tamanho_bytes=size_bytes, checksum=checksum,
        linhas_malformadas=malformed, carga=kind, codificacao=encoding, erro=None,
    )


def bronze_failure(spark, dataset, year, start, end, error) -> DataFrame:
    return record(
        spark, S.BRONZE_AUDIT_SCHEMA, dataset, year, start, end,
        status=S.STATUS_FAILED, linhas=0, tamanho_bytes=0, checksum="", linhas_malformadas=0, erro=error,
    )


def silver_success(spark, dataset, year, start, end, rows_before, rows_after) -> DataFrame:
    return record(
        spark, S.SILVER_AUDIT_SCHEMA, dataset, year, start, end,
        status=S.STATUS_OK, linhas_antes=rows_before, linhas_depois=rows_after, erro=None,
    )


def silver_failure(spark, dataset, year, start, end, error) -> DataFrame:
    return record(
        spark, S.SILVER_AUDIT_SCHEMA, dataset, year, start, end,
        status=S.STATUS_FAILED, linhas_antes=0, linhas_depois=0, erro=error,
    )
