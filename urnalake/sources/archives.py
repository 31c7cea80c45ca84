"""Archive landing: find the CSV members of many ZIP files, take the largest, extract it.

Three Spark steps: list members, rank them per archive, extract the chosen ones. The work
is spread by archive; a deflate stream cannot be split, so one archive is read by one task,
but as a stream of small blocks, never whole in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.sources.files import chunks, open_filesystem, qualified

MEMBER_SUFFIX = ".csv"


class NoCsvInArchive(ValueError):
    """An archive without a CSV member."""


def _spread(archives: DataFrame) -> DataFrame:
    parallelism = archives.sparkSession.sparkContext.defaultParallelism
    return archives.repartition(parallelism)


def members(archives: DataFrame) -> DataFrame:
    """(archive, position, member, size) of every member of every archive in column ``path``."""

    def list_members(batches):
        import zipfile

        import pandas as pd

        for batch in batches:
            for path in batch["path"]:
                filesystem, inside = open_filesystem(path)
                with filesystem.open_input_file(inside) as raw, zipfile.ZipFile(raw) as archive:
                    entries = archive.infolist()
                yield pd.DataFrame(
                    {
                        "archive": path,
                        "position": range(len(entries)),
                        "member": [e.filename for e in entries],
                        "size": [e.file_size for e in entries],
                    }
                )

    return _spread(archives.select("path")).mapInPandas(
        list_members, "archive string, position long, member string, size long"
    )


def largest_csv(listing: DataFrame) -> DataFrame:
    """The largest CSV member per archive, the first of equally large ones."""
    order = Window.partitionBy("archive").orderBy(F.desc("size"), F.asc("position"))
    return (
        listing.where(F.col("member").endswith(MEMBER_SUFFIX))
        .withColumn("__n", F.row_number().over(order))
        .where("__n = 1")
        .drop("__n")
    )


def extract(chosen: DataFrame, out_dir: str) -> DataFrame:
    """Extract (archive, member) rows below the qualified ``out_dir``; path, size, SHA-256 of each CSV.

    A task writes under a name of its own and renames at the end, so a retried or
    speculative task cannot leave a half-written file behind the final name.
    """

    def extract_members(batches):
        import hashlib
        import uuid
        import zipfile

        import pandas as pd

        for batch in batches:
            for path, member in zip(batch["archive"], batch["member"], strict=True):
                source, inside = open_filesystem(path)
                target, folder = open_filesystem(
                    f"{out_dir.rstrip('/')}/{hashlib.sha256(path.encode()).hexdigest()[:24]}"
                )
                target.create_dir(folder, recursive=True)
                final, partial = f"{folder}/raw.csv", f"{folder}/_{uuid.uuid4().hex}"
                digest, size = hashlib.sha256(), 0
                with (
                    source.open_input_file(inside) as raw,
                    zipfile.ZipFile(raw) as archive,
                    archive.open(member) as stream,
                    target.open_output_stream(partial) as out,
                ):
                    for block in chunks(stream):
                        out.write(block)
                        digest.update(block)
                        size += len(block)
                target.move(partial, final)
                yield pd.DataFrame(
                    {
                        "archive": [path],
                        "member": [member],
                        "csv_path": [f"{out_dir.rstrip('/')}/{folder.rsplit('/', 1)[-1]}/raw.csv"],
                        "size_bytes": [size],
                        "sha256": [digest.hexdigest()],
                    }
                )

    return _spread(chosen.select("archive", "member")).mapInPandas(
        extract_members,
        "archive string, member string, csv_path string, size_bytes long, sha256 string",
    )


def land_archives(spark: SparkSession, archives: DataFrame, out_dir: str) -> DataFrame:
    """Extract one CSV per archive; the result is a written table, so nothing runs twice."""
    out_dir = qualified(spark, out_dir)
    log = f"{out_dir}/_landed"
    chosen = largest_csv(members(archives))
    extract(chosen, out_dir).write.mode("overwrite").parquet(log)
    landed = spark.read.parquet(log)
    without = archives.join(landed, archives["path"] == landed["archive"], "left_anti")
    examples = [row["path"] for row in without.select("path").limit(5).collect()]
    if examples:
        raise NoCsvInArchive(f"no CSV member in {', '.join(examples)}")
    return landed
