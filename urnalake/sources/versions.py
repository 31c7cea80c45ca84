"""Tables whose years are replaced at once: run folders, and a numbered manifest that names them.

    <root>/runs/run=<id>/year=<year>/part-…    data of one commit, never changed
    <root>/versions/<number>.json              the folder of every year, one file per version

A commit writes its run folder first, then creates the next manifest, which must not exist yet.
Until then nobody sees its data, afterwards everybody sees all of it. A reader takes one manifest
and keeps to it, so years replaced meanwhile stay as they were for that reader.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.sources.files import hadoop_path
from urnalake.sources.tables import PARQUET_OPTIONS

#: Commits that may come in between before one gives up.
MOST_ATTEMPTS = 100


class ConcurrentChange(RuntimeError):
    """Another commit replaced the same year after this one began."""


@dataclass(frozen=True)
class Version:
    """One state of a table: the run that holds each year. Version 0 has no year."""

    number: int
    runs: dict[int, str]


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/versions"


def versions_in(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all versions, the oldest first. One folder is listed, no file opened."""
    filesystem, folder = hadoop_path(spark, _manifests(root))
    if not filesystem.exists(folder):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(folder)]
    return sorted(int(found[1]) for name in names if (found := re.fullmatch(r"(\d{20})\.json", name)))


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version of the table, by default the newest."""
    if number is None:
        number = max(versions_in(spark, root), default=0)
    if number == 0:
        return Version(0, {})
    filesystem, path = hadoop_path(spark, f"{_manifests(root)}/{number:020d}.json")
    stream = filesystem.open(path)
    try:
        content = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()
    return Version(number, {int(year): run for year, run in content["runs"].items()})


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Put a complete file there in one step; false if there is one already.

    A hard link does that on a local disk, a rename without overwriting on HDFS. Object stores
    that copy when they rename have no such step, and are refused.
    """
    filesystem, target = hadoop_path(spark, path)
    scheme = filesystem.getUri().getScheme()
    if scheme not in ("file", "hdfs", "viewfs"):
        raise ValueError(f"{scheme} cannot create a file in one step; keep versions on HDFS")
    filesystem.mkdirs(target.getParent())
    _, draft = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = filesystem.create(draft, False)
    try:
        stream.write(bytearray(content.encode("utf-8")))
    finally:
        stream.close()
    try:
        if scheme == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        return bool(not filesystem.exists(target) and filesystem.rename(draft, target))
    except FileExistsError:
        return False
    finally:
        filesystem.delete(draft, False)


def stage(df: DataFrame, root: str, observe: dict[str, Column] | None = None) -> tuple[str, dict]:
    """Write rows with column ``year`` to a run folder of their own; (run, figures of that write)."""
    seen = Observation()
    figures = {"rows": F.count(F.lit(1)), **(observe or {})}
    run = uuid.uuid4().hex
    observed = df.observe(seen, *[c.alias(name) for name, c in figures.items()])
    observed.write.options(**PARQUET_OPTIONS).partitionBy("year").parquet(f"{root.rstrip('/')}/runs/run={run}")
    return run, seen.get


def commit(spark: SparkSession, root: str, run: str, years: list[int], base: Version) -> Version:
    """Make ``years`` those of ``run``, in one step; years the run has no rows of are empty then.

    ``base`` is the version the run was made from. Where other commits came first, this one follows
    them if they left its years alone, and raises :class:`ConcurrentChange` otherwise.
    """
    for _ in range(MOST_ATTEMPTS):
        newest = version(spark, root)
        changed = [y for y in years if newest.runs.get(y) != base.runs.get(y)]
        if changed:
            raise ConcurrentChange(f"years {changed} were replaced by version {newest.number} or one before it")
        runs = {**newest.runs, **dict.fromkeys(years, run)}
        content = json.dumps({"runs": {str(y): r for y, r in sorted(runs.items())}})
        if _create(spark, f"{_manifests(root)}/{newest.number + 1:020d}.json", content):
            return Version(newest.number + 1, runs)
    raise ConcurrentChange(f"{MOST_ATTEMPTS} other commits came first")


def replace_years(df: DataFrame, root: str, years: list[int], observe: dict[str, Column] | None = None) -> tuple[Version, dict]:
    """Replace ``years`` by the rows of ``df`` (with column ``year``); (new version, figures).

    Rows of other years are an error, which leaves the table as it is.
    """
    spark = df.sparkSession
    base = version(spark, root)
    other = F.count(F.when(F.coalesce(~F.col("year").isin(years), F.lit(True)), 1))
    run, figures = stage(df, root, {**(observe or {}), "other_years": other})
    if figures.pop("other_years"):
        raise ValueError(f"there are rows of other years than {years}")
    return commit(spark, root, run, years, base), figures


def read_years(
    spark: SparkSession, root: str, years: list[int], layout: T.StructType = S.SILVER_SCHEMA, at: Version | None = None
) -> DataFrame:
    """The contract columns of the requested years of one version, tagged with ``Ano``.

    The version's folders of these years are all that is listed, in one scan, and no footer is
    read for the columns. Years without data are not there.
    """
    at = at or version(spark, root)
    filesystem, _ = hadoop_path(spark, root)
    base = f"{root.rstrip('/')}/runs"
    folders = [f"{base}/run={at.runs[y]}/year={y}" for y in sorted(set(years)) if y in at.runs]
    folders = [f for f in folders if filesystem.exists(hadoop_path(spark, f)[1])]
    columns = T.StructType([*layout.fields, T.StructField("run", T.StringType()), T.StructField("year", T.IntegerType())])
    if folders:
        table = spark.read.schema(columns).option("basePath", base).parquet(*folders)
    else:
        table = spark.createDataFrame([], columns)
    return table.drop("run").withColumn("Ano", F.col("year").cast("int"))


def unused_runs(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Runs that none of the newest ``keep`` versions name: left by killed commits or replaced.

    A commit that is under way is among them, so they are for deleting when none is.
    """
    filesystem, folder = hadoop_path(spark, f"{root.rstrip('/')}/runs")
    if not filesystem.exists(folder):
        return []
    used = {run for n in versions_in(spark, root)[-keep:] for run in version(spark, root, n).runs.values()}
    names = [status.getPath().getName() for status in filesystem.listStatus(folder)]
    return sorted(n.removeprefix("run=") for n in names if n.startswith("run=") and n.removeprefix("run=") not in used)
