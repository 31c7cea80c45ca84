"""Display text and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urnalake import schema as S


def _finite_or_word(value: Column, finite: Column) -> Column:
    inf = float("inf")
    return (
        F.when(F.isnan(value), "nan")
        .when(value == F.lit(inf), "inf")
        .when(value == F.lit(-inf), "-inf")
        .otherwise(finite)
    )


def percent_text(rate: Column | str) -> Column:
    """One decimal and a percent sign, ties to even: 82.25 is ``82.2%``.

    ``format_string('%.1f')`` rounds ties up, so the decimal pattern is used instead.
    """
    rate = F.col(rate) if isinstance(rate, str) else rate
    number = F.call_function("format_number", rate.cast("double"), F.lit("0.0"))
    return F.when(rate.isNotNull(), F.concat(_finite_or_word(rate, number), F.lit("%")))


def grouped_text(count: Column | str) -> Column:
    """A whole number with thousands separators: 1,234,567."""
    return F.format_number(count, 0)


#: Published addresses, what a session can open (object stores, HDFS, files), and local paths.
ORIGIN_PATTERN = "(?s)^(https?://|s3a?://|hdfs://|abfss?://|gs://|file:/|/|.:)"


def dataset_id(dataset: Column | str, year: Column | str) -> Column:
    return F.concat_ws(":", dataset, year)


def source_id(dataset: Column | str, year: Column | str) -> Column:
    return F.concat_ws(":", F.lit(S.SOURCE_PREFIX), dataset, year)


def is_valid_origin(origin: Column | str) -> Column:
    """http(s) and storage addresses, absolute paths and drive paths; everything else is rejected."""
    origin = F.col(origin) if isinstance(origin, str) else origin
    return origin.rlike(ORIGIN_PATTERN)


def sample_key(columns: list[str], seed: int = S.SAMPLE_SEED) -> Column:
    """Seeded content hash: the same row gets the same key on every run and cluster size."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
