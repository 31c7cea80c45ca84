"""What the operators share: the package on the workers, tables, row-wise Arrow steps."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import urnalake
from urnalake.session import scratch_folder

_SHIPPED = "_urnalake_shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(urnalake.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="urnalake-"), "urnalake_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("urnalake", os.path.relpath(path, root)))
    context.addPyFile(os.path.abspath(target))
    setattr(context, _SHIPPED, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, read by several steps."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, step: Callable[[dict], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for a step from a dict of column lists to a dict of columns."""
    ship(df.sparkSession)
    names = [part.split()[0].strip("`") for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = step({name: batch.column(name) for name in batch.schema.names})
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)
