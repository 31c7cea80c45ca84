"""The encoding of each landed file: UTF-8 if all of it is valid UTF-8, else ISO-8859-1.

Files are judged in byte ranges that tasks share. A range is cut at the first byte at or behind each
of its ends that does not continue a character, so a file is valid if and only if all its pieces are,
wherever ranges end.
"""

from __future__ import annotations

import codecs
import re
import sys
from typing import BinaryIO

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.sources import files

UTF_8, LATIN_1 = "UTF-8", "ISO-8859-1"
#: In place of an encoding: each file has the one that its bytes tell.
PER_FILE = "per file"

RANGE_BYTES = 128 << 20
_COMPRESSED = re.compile(r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zip)$", re.IGNORECASE)


def character_start(file: BinaryIO, position: int) -> int:
    """The first byte at or behind ``position`` that begins a character, in a file that is UTF-8.

    At most three bytes continue a character. A fourth makes the piece before it invalid.
    """
    if position == 0:
        return 0
    file.seek(position)
    head = file.read(4)
    continued = next((i for i, byte in enumerate(head) if byte & 0xC0 != 0x80), len(head))
    return position + continued


def is_utf8(file: BinaryIO, start: int, end: int) -> bool:
    """Whether the characters that begin in the range are valid; read a megabyte at a time."""
    end = character_start(file, end)
    start = character_start(file, start)
    decoder = codecs.getincrementaldecoder("utf-8")()
    file.seek(start)
    try:
        while start < end:
            block = file.read(min(files.CHUNK, end - start))
            if not block:
                raise OSError("a file has become shorter while it was read")
            start += len(block)
            decoder.decode(block)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return False
    return True


def file_encodings(listed: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, encoding) of the files in (path, length). Plain ASCII and empty files are UTF-8."""

    def judge(batches):
        import pandas as pd

        for batch in batches:
            for path, start, size in zip(batch["path"], batch["start"], batch["size"], strict=True):
                filesystem, inside = files.open_filesystem(path)
                with filesystem.open_input_file(inside) as file:
                    yield pd.DataFrame({"path": [path], "valid": [is_utf8(file, start, start + size)]})

    ranges = files.byte_ranges(listed, range_bytes).select("path", "start", "size")
    judged = ranges.mapInPandas(judge, "path string, valid boolean")
    encoding = F.when(F.every("valid"), UTF_8).otherwise(LATIN_1)
    return judged.groupBy("path").agg(encoding.alias("encoding"))


def files_by_encoding(
    spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES
) -> dict[str, list[str]]:
    """The files below ``paths`` that are not empty, by encoding, as paths to read them by.

    The driver holds their names, as Spark's listing does. Compressed files are refused, since their
    bytes tell nothing about the text.
    """
    listed = [files.list_files(spark, path) for path in paths]
    every = listed[0]
    for more in listed[1:]:
        every = every.unionByName(more)
    every = every.where("length > 0").distinct()
    found: dict[str, list[str]] = {}
    for row in file_encodings(every, range_bytes).orderBy("path").collect():
        if _COMPRESSED.search(row["path"]):
            raise ValueError(f"{row['path']} is compressed: extract it first, or name its encoding")
        found.setdefault(row["encoding"], []).append(_literal(row["path"]))
    return found


def _literal(path: str) -> str:
    """A path that Spark does not take for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def summary(chosen: dict[str, list[str]]) -> str:
    """Encodings and their numbers of files, as the audit log has them."""
    return ",".join(f"{encoding}:{len(paths)}" for encoding, paths in sorted(chosen.items()))


# Tasks carry the helpers of this module with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
