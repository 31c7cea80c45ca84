"""Landed turnout CSV files: everything is read as text, then typed by column name."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.functions.casting import cast_by_name, nullify_tokens, quoted
from urnalake.sources import encodings, quoted_csv

CORRUPT = "__malformed_line"
_TARGET_TEXT_BYTES = 1 << 30


def csv_options(encoding: str = "UTF-8") -> dict[str, str]:
    return {
        "sep": S.CSV_SEPARATOR,
        "header": "true",
        "quote": '"',
        "escape": '"',
        "encoding": encoding,
        # Compare the header of every file with the schema instead of trusting positions.
        "enforceSchema": "false",
        # Parse whole lines, so that a malformed one is noticed whichever columns are used.
        "columnPruning": "false",
    }


def read_landed(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str | Mapping[str, Sequence[str]] = "UTF-8",
    keep_malformed: bool = False,
    malformed: Observation | None = None,
    multi_line: bool = False,
    range_bytes: int = quoted_csv.RANGE_BYTES,
) -> DataFrame:
    """Landed columns as strings in header order, whatever they are.

    Folders are read with everything below them, as :func:`files.list_files` lists them. A line
    with too few fields is padded with NULL, one with too many fails the job; ``malformed``
    counts the former as ``malformed`` while the rows are used. With ``keep_malformed`` the text
    of both kinds is kept in an extra column instead. ``multi_line`` allows line breaks inside
    quotes: files are read twice then, in ranges of ``range_bytes`` that tasks share.

    With :data:`encodings.PER_FILE` each file is read by the encoding its bytes tell; files by
    encoding, as :func:`encodings.files_by_encoding` gives them, are taken in place of ``paths``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if encoding == encodings.PER_FILE:
        encoding = encodings.files_by_encoding(spark, paths)
    groups = {encoding: paths} if isinstance(encoding, str) else dict(encoding)
    headers = {e: _header(spark, found, e, multi_line) for e, found in groups.items()}
    names = next(iter(headers.values()), [])
    if not all(headers.values()) or not names:
        raise ValueError(f"no header line in {', '.join(paths)}")
    if any(header != names for header in headers.values()):
        raise ValueError(f"the header differs between files of different encodings: {headers}")
    parts = [_lines(spark, found, names, e, multi_line, range_bytes) for e, found in groups.items()]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    if malformed is not None:
        # The first field is counted as well: no CSV query may use the malformed text alone.
        counts = [F.count(CORRUPT).alias("malformed"), F.count(quoted(names[0])).alias("first_fields")]
        lines = lines.observe(malformed, *counts)
    return lines if keep_malformed else reject_long_lines(lines, names)


def _reader_options(encoding: str, multi_line: bool) -> dict[str, str]:
    return csv_options(encoding) | {"recursiveFileLookup": "true", "multiLine": str(multi_line).lower()}


def _header(spark: SparkSession, paths: Sequence[str], encoding: str, multi_line: bool) -> list[str]:
    return spark.read.options(**_reader_options(encoding, multi_line)).csv(list(paths)).columns


def _lines(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], encoding: str, multi_line: bool, range_bytes: int
) -> DataFrame:
    """Landed columns and the text of malformed lines, of files of one encoding."""
    layout = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    options = _reader_options(encoding, multi_line) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if not multi_line:
        return spark.read.options(**options).schema(layout).csv(list(paths))
    records = quoted_csv.records(spark, list(paths), names, S.CSV_SEPARATOR, encoding, range_bytes)
    ddl = ", ".join("`" + name.replace("`", "``") + "` string" for name in layout.names)
    # Behind a generator a record is parsed once; a plain column would be again in every filter on its fields.
    return records.select(F.inline(F.array(F.from_csv("record", ddl, options | {"header": "false"}))))


def reject_long_lines(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail on lines with more fields than the header; shorter ones stay padded with NULL.

    The test is a filter, so it runs whichever columns are used later, and needs no pass of
    its own. It names the first field, as no CSV query may use the malformed text alone.
    """
    first = F.coalesce(quoted(names[0]), F.lit(""))
    problem = F.concat(F.lit(f"more than {len(names)} fields: "), F.col(CORRUPT), F.left(first, F.lit(0)))
    kept = lines.where(F.when(_has_extra_fields(len(names)), F.raise_error(problem).cast("boolean")).otherwise(True))
    return kept.drop(CORRUPT)


# A quoted field begins at a separator or the line's start and ends at a separator or the line's
# end, with quote signs doubled inside. Other quote signs are plain text.
_QUOTED_FIELD = rf'(?s)(^|{S.CSV_SEPARATOR})"[^"]*(?:""[^"]*)*"(?={S.CSV_SEPARATOR}|\r?$)'


def _has_extra_fields(expected: int) -> Column:
    """Only malformed lines carry text here, so the count costs nothing on good ones."""
    unquoted = F.regexp_replace(F.col(CORRUPT), _QUOTED_FIELD, "$1")
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(S.CSV_SEPARATOR), F.lit("")))
    return F.col(CORRUPT).isNotNull() & (separators + 1 > expected)


def typed(landed: DataFrame) -> DataFrame:
    return cast_by_name(nullify_tokens(landed))


def with_lineage(df: DataFrame, source: str | Column, at: Column | None = None) -> DataFrame:
    """Two lineage columns. The timestamp is fixed once per query, so a run has one value."""
    return df.withColumns(
        {
            S.LINEAGE_TIMESTAMP: F.current_timestamp() if at is None else at,
            S.LINEAGE_SOURCE: F.lit(source) if isinstance(source, str) else source,
        }
    )


def fewer_splits(df: DataFrame, input_bytes: int) -> DataFrame:
    """Let each task read about a gigabyte of text, so that output files are not tiny.

    ``coalesce`` only groups input splits; nothing is shuffled. Small inputs keep one split
    per core.
    """
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(parallelism, math.ceil(input_bytes / _TARGET_TEXT_BYTES)))
