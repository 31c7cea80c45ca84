"""Year-partitioned Parquet tables and the CSV samples beside them."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.functions.casting import cast_by_name
from urnalake.operators.union import unite
from urnalake.sources.files import hadoop_path, path_exists

PARQUET_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3"}


def write_year(df: DataFrame, root: str, year: int, observe: dict[str, Column] | None = None) -> dict:
    """Replace one year's partition and return figures observed during that same write.

    Other years stay. The new files become visible at job commit, so a failed run leaves
    the year as it was. ``rows`` is always among the figures.
    """
    seen = Observation()
    figures = {"rows": F.count(F.lit(1)), **(observe or {})}
    observed = df.observe(seen, *[c.alias(name) for name, c in figures.items()])
    (
        observed.withColumn("year", F.lit(year))
        .write.mode("overwrite")
        .options(**PARQUET_OPTIONS, partitionOverwriteMode="dynamic")
        .partitionBy("year")
        .parquet(root)
    )
    result = seen.get
    if result["rows"] == 0:
        # Dynamic overwrite touches no partition then; leave an empty one in place of old data.
        empty = df.limit(0)
        empty.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(f"{root.rstrip('/')}/year={year}")
    return result


def add_batch(df: DataFrame, root: str, name: str, staging: str) -> dict[int, int]:
    """Add rows (with column ``year``) to their years' partitions under a batch name; rows per year.

    The batch is written beside the table, then its files are moved in under names that begin
    with the batch's. Files of an earlier attempt at the same batch go first, so adding a batch
    again changes nothing. The moves are one call per file on the driver, and readers may see a
    part of the batch until the last one is done.
    """
    spark = df.sparkSession
    columns = hashlib.sha256("\0".join(c for c in df.columns if c != "year").encode()).hexdigest()[:8]
    folder = f"{staging.rstrip('/')}/{name}"
    df.write.mode("overwrite").options(**PARQUET_OPTIONS).partitionBy("year").parquet(folder)
    filesystem, source = hadoop_path(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for year in years_in(spark, root):
        for status in filesystem.listStatus(path(f"{root.rstrip('/')}/year={year}")):
            if status.getPath().getName().startswith(f"batch-{name}-"):
                filesystem.delete(status.getPath(), False)
    rows = {}
    for year in years_in(spark, folder):
        partition = f"{folder}/year={year}"
        rows[year] = spark.read.parquet(partition).count()
        target = path(f"{root.rstrip('/')}/year={year}")
        filesystem.mkdirs(target)
        for status in filesystem.listStatus(path(partition)):
            file = status.getPath()
            if not filesystem.rename(file, path(target, f"batch-{name}-{columns}-{file.getName()}")):
                raise OSError(f"cannot move {file} to {target}")
    filesystem.delete(source, True)
    return rows


def years_in(spark: SparkSession, root: str) -> list[int]:
    """Years that have a partition. Lists one folder level and opens no data file."""
    filesystem, target = hadoop_path(spark, root)
    if not filesystem.exists(target):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(target)]
    return sorted(int(m.group(1)) for n in names if (m := re.fullmatch(r"year=(\d+)", n)))


def years_frame(spark: SparkSession, years: list[int]) -> DataFrame:
    """A frame (ano) of a year list; years are at most the few the manifest rule allows."""
    return spark.createDataFrame([(int(y),) for y in years], "ano int")


def read_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """One year of a table without the partition column; a column only some files have is NULL in the others."""
    return unite(year_parts(spark, root, year))


def year_parts(spark: SparkSession, root: str, year: int) -> list[DataFrame]:
    """One year of a table, a frame for all files of one set of columns.

    A load has one set and so has each batch, told by the file name: one footer per frame tells its
    columns, however many batches there are.
    """
    folder = f"{root.rstrip('/')}/year={year}"
    filesystem, target = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in filesystem.listStatus(target)] if filesystem.exists(target) else []
    globs = {_same_columns(n) for n in names if n.startswith("batch-")}
    if globs and any(n.startswith("part-") for n in names):
        globs.add("part-*")
    if len(globs) < 2:
        return [spark.read.parquet(folder)]
    ordered = sorted(globs, key=lambda g: (g != "part-*", g))
    return [spark.read.option("pathGlobFilter", glob).parquet(folder) for glob in ordered]


def _same_columns(name: str) -> str:
    """The glob of batch files with the columns of this one; older names tell only their stream."""
    if found := re.match(r"batch-.*-([0-9a-f]{8})-part-", name):
        return f"batch-*-{found.group(1)}-part-*"
    return re.sub(r"-\d{12}-part-.*", f"-{'?' * 12}-part-*", name)


def read_years(
    spark: SparkSession, root: str, years: list[int], layout: T.StructType = S.SILVER_SCHEMA
) -> DataFrame:
    """The contract columns of the requested years, tagged with ``Ano``; years without data are not there.

    One read of the table root: the filter prunes partitions, and as the columns are known
    no file is opened to infer them.
    """
    columns = T.StructType([*layout.fields, T.StructField("year", T.IntegerType())])
    if path_exists(spark, root):
        table = spark.read.schema(columns).parquet(root)
    else:
        table = spark.createDataFrame([], columns)
    return table.where(F.col("year").isin(years)).withColumn("Ano", F.col("year").cast("int"))


def read_years_in_full(spark: SparkSession, root: str, years: list[int]) -> DataFrame:
    """Like ``read_years`` with all columns; a column only some years have is NULL in the others.

    Years that have a column in different types are united in one that holds the values of all, see
    :func:`unite`.

    One footer tells the columns of all files that :func:`year_parts` puts together. Merging the
    schema of every file would open them all.
    """
    present = [y for y in years if y in set(years_in(spark, root))]
    if not present:
        return read_years(spark, root, [])
    frames = [
        read_year(spark, root, y).withColumns({"year": F.lit(y), "Ano": F.lit(y)}) for y in present
    ]
    return unite(frames)


def union_years(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; a frame with other columns is an error."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def write_samples(sample: DataFrame, root: str) -> None:
    """Comma-separated samples, one folder per year (column ``year``)."""
    sample.write.mode("overwrite").option("header", "true").partitionBy("year").csv(root)


def read_samples(spark: SparkSession, root: str, types: T.StructType = S.SILVER_SCHEMA) -> DataFrame:
    """Samples back with silver types, bound by name, tagged with ``Ano``."""
    text = spark.read.option("header", "true").option("enforceSchema", "false").csv(root)
    return cast_by_name(text, types).withColumn("Ano", F.col("year").cast("int"))


def register_views(spark: SparkSession, **roots: str) -> None:
    """Temporary views over table folders, for direct SQL."""
    for name, root in roots.items():
        spark.read.parquet(root).createOrReplaceTempView(name)
