"""Bronze load as a file stream: each run takes the files no earlier run has taken.

The checkpoint does for files what the audit log does for years. Landing files lie in
``<landing>/year=Y/`` and must share one header, which is compared with ``columns``. Batches are
added to the same table that ``ingest`` writes and are audited in the same log.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.functions.text import source_id
from urnalake.operators.quality import require_contract
from urnalake.plans.lake import Lake
from urnalake.sources import audit_log, landed_csv, tables
from urnalake.sources.files import qualified


MALFORMED = "__is_malformed"


def landed_stream(
    spark: SparkSession,
    landing: str,
    columns: Sequence[str],
    encoding: str = "UTF-8",
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Landed columns as strings, ``year``, and whether a line was too short (``MALFORMED``)."""
    texts = [T.StructField(c, T.StringType()) for c in [*columns, landed_csv.CORRUPT]]
    lines = (
        spark.readStream.options(**landed_csv.csv_options(encoding))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=landed_csv.CORRUPT)
        .option("maxFilesPerTrigger", files_per_trigger)
        .schema(T.StructType(texts).add("year", T.IntegerType()))
        .csv(landing)
    )
    # Lines that are too long fail, so the malformed ones that stay are too short.
    return landed_csv.reject_long_lines(lines.withColumn(MALFORMED, F.col(landed_csv.CORRUPT).isNotNull()), columns)


def load_new_files(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    columns: Sequence[str],
    encoding: str = "UTF-8",
) -> None:
    """Add all new landing files to the lake's bronze table and stop.

    Every batch has a name made of the checkpoint and its number. A batch that runs again after
    a failure replaces the files of that name, so none is added twice and none is lost. Each
    year of a batch gets an audit row, of a kind that does not count as the load of the year.
    ``ingest`` replaces a year, streamed rows included; ``build_silver`` builds a year again that
    batches were added to.
    """
    landed = landed_stream(spark, landing, columns, encoding)
    require_contract(landed.drop("year", MALFORMED))
    source = source_id(F.lit(S.BRONZE_DATASET), F.col("year"))
    bronze = landed_csv.with_lineage(landed_csv.typed(landed), source)
    stream = hashlib.sha256(qualified(spark, checkpoint).encode()).hexdigest()[:16]

    def add(batch: DataFrame, number: int) -> None:
        start = datetime.now(UTC)
        years = tables.years_in(spark, landing)
        short = Observation()
        counts = [F.count_if(F.col(MALFORMED) & (F.col("year") == y)).alias(str(y)) for y in years]
        counted = batch.observe(short, F.count(F.lit(1)).alias("rows"), *counts).drop(MALFORMED)
        rows = tables.add_batch(counted, lake.bronze, f"{stream}-{number:012d}", f"{lake.landing}/_batches")
        for year, count in sorted(rows.items()):
            success = audit_log.bronze_success(
                spark, S.BRONZE_DATASET, year, start, datetime.now(UTC), count, None, None,
                short.get.get(str(year)), S.KIND_BATCH,
            )
            audit_log.append(success, lake.bronze_log)

    query = (
        bronze.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
