"""Files on any storage the cluster shares, opened from inside tasks."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20


def open_filesystem(path: str):
    """(filesystem, path inside it) of a qualified path.

    A path without a scheme would mean the disk of whichever executor runs the task, so it is
    refused; see :func:`qualified`.
    """
    from pyarrow import fs

    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if ":/" not in path:
        raise ValueError(f"{path} names no filesystem")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def chunks(stream: BinaryIO) -> Iterator[bytes]:
    while block := stream.read(CHUNK):
        yield block


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of the files below ``path``, empty ones too; their content is not read.

    Spark's file sources pass over empty files, but their index knows them.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    names = [re.sub("^file:/+", "file:/", unquote(name)) for name in found.inputFiles()]
    every = spark.createDataFrame([(name,) for name in names], "path string")
    listed = every.join(found.select("path", "length"), "path", "left")
    return listed.select("path", F.coalesce("length", F.lit(0)).alias("length"))


def digests(files: DataFrame) -> DataFrame:
    """SHA-256 and size per file. A file is hashed in one task, a megabyte at a time."""

    def hash_files(batches):
        import hashlib

        import pandas as pd

        for batch in batches:
            for path in batch["path"]:
                filesystem, inside = open_filesystem(path)
                digest, size = hashlib.sha256(), 0
                with filesystem.open_input_stream(inside) as stream:
                    for block in chunks(stream):
                        digest.update(block)
                        size += len(block)
                yield pd.DataFrame({"path": [path], "size_bytes": [size], "sha256": [digest.hexdigest()]})

    return files.select("path").mapInPandas(hash_files, "path string, size_bytes bigint, sha256 string")


#: Bytes of a leaf of a digest tree, and children of a node.
RANGE_BYTES = 8 << 20
FANOUT = 1024


#: Bytes that tasks are dealt in ranges, but for ranges that are longer.
TASK_BYTES = 64 << 20


def _last(range_bytes: int) -> Column:
    return F.greatest(F.ceil(F.col("length") / range_bytes) - 1, F.lit(0))


def range_tasks(files: DataFrame, range_bytes: int) -> int:
    """Tasks that the ranges of the files in (path, length) are dealt to.

    It goes with the bytes behind the ranges. Adaptive execution would go by the few bytes of the rows
    that name them, and merge them into one task.
    """
    size, ranges = files.agg(F.sum("length"), F.sum(_last(range_bytes) + 1)).first()
    wanted = max(files.sparkSession.sparkContext.defaultParallelism, math.ceil((size or 0) / TASK_BYTES))
    return max(min(wanted, ranges or 0), 1)


def byte_ranges(files: DataFrame, range_bytes: int, tasks: int | None = None) -> DataFrame:
    """(path, length, last, number, start, size): files of (path, length) cut into ranges, in any order.

    An empty file is one empty range. Ranges are dealt to ``tasks`` one by one, else to as many as
    :func:`range_tasks` says, so one large file is as many tasks' work as many small ones.
    """
    tasks = tasks or range_tasks(files, range_bytes)
    files = files.select("path", "length", _last(range_bytes).alias("last"))
    cut = files.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    start = F.col("number") * range_bytes
    dealt = cut.withColumn("start", start).withColumn("size", F.least(F.lit(range_bytes), F.col("length") - start))
    return dealt.repartition(tasks, "path", "number")


def range_digests(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, last, number, sha256) of every byte range; a range is read a megabyte at a time."""

    def hash_ranges(batches):
        import hashlib

        import pandas as pd

        for batch in batches:
            for path, last, number, start, size in zip(*(batch[c] for c in ("path", "last", "number", "start", "size")), strict=True):
                filesystem, inside = open_filesystem(path)
                digest, left = hashlib.sha256(), size
                with filesystem.open_input_file(inside) as file:
                    file.seek(start)
                    while left and (block := file.read(min(CHUNK, left))):
                        digest.update(block)
                        left -= len(block)
                if left:
                    raise OSError(f"{path} has become shorter while it was read")
                yield pd.DataFrame({"path": [path], "last": [last], "number": [number], "sha256": [digest.hexdigest()]})

    ranges = byte_ranges(files, range_bytes).select("path", "last", "number", "start", "size")
    return ranges.mapInPandas(hash_ranges, "path string, last bigint, number bigint, sha256 string")


def tree_digests(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(path, sha256) from :func:`range_digests`: the root of a tree over each file's ranges.

    A leaf is the SHA-256 of a range. A node is the SHA-256 of the hex digests of up to ``fanout``
    neighbouring nodes below it, one behind the other. There is at least one level of nodes, and
    as many as leave one node per file. So the root depends on the content, the range size and the
    fanout alone, not on how tasks share the work, and no group is larger than the fanout.
    """
    last = leaves.agg(F.max("last")).first()[0] or 0
    level = next_level(leaves, fanout)
    roots = level.where("last = 0")
    while last := last // fanout:
        level = next_level(level.where("last > 0"), fanout)
        roots = roots.unionByName(level.where("last = 0"))
    return roots.select("path", "sha256")


def next_level(nodes: DataFrame, fanout: int) -> DataFrame:
    """(path, last, number, sha256) of the nodes above; ``last`` is the highest number of the file."""
    ordered = F.array_sort(F.collect_list(F.struct("number", "sha256")))
    joined = F.array_join(F.transform(ordered, lambda n: n["sha256"]), "").cast("binary")
    above = [F.floor(F.col(c) / fanout).alias(f"{c}_above") for c in ("last", "number")]
    return nodes.groupBy("path", *above).agg(F.sha2(joined, 256).alias("sha256")).select(
        "path", F.col("last_above").alias("last"), F.col("number_above").alias("number"), "sha256"
    )


def folder_digest(file_digests: DataFrame) -> DataFrame:
    """(n_files, size_bytes, sha256) over all files of a folder, whatever their order.

    A single file keeps its own checksum. Of several, the checksums are cut into four numbers of
    64 bits, which are added up and hashed with the count and the size: no list of files is
    gathered in one task, all digits count, and files with equal content count as often as they
    are there.
    """
    pieces = [
        F.sum(F.conv(F.substring("sha256", start, 16), 16, 10).cast("decimal(20,0)")).cast("string")
        for start in range(1, 65, 16)
    ]
    combined = F.sha2(F.concat_ws("|", F.count(F.lit(1)), F.sum("size_bytes"), *pieces), 256)
    return file_digests.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
        F.when(F.count(F.lit(1)) == 1, F.min("sha256")).otherwise(combined).alias("sha256"),
    )


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop filesystem, path) as the session itself sees them."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the filesystem the session finds it in; tasks get no other."""
    filesystem, target = hadoop_path(spark, path)
    return str(filesystem.makeQualified(target))


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = hadoop_path(spark, path)
    return filesystem.exists(target)


# Tasks carry the helpers of this module with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
