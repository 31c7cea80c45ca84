"""Records of CSV files with line breaks inside quotes, from byte ranges in parallel.

Whether a byte lies inside quotes depends on all bytes before it. Each range therefore tells where
it would end up from each state it might begin in: it is a map of states to states. Composed from
a file's first range on, these maps give the state every range begins in, and a second pass finds
the records. A record belongs to the range that the line break in front of it lies in.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.sources import files

#: Bytes of a range: what a task holds at a time, beside a record that reaches beyond it.
RANGE_BYTES = 32 << 20
#: Records handed on at a time.
_AT_A_TIME = 5000
#: Bytes first read behind a range for the end of its last record; doubled until that is found.
_BEYOND = 4 << 10

#: What may come next: a new field, more of a plain field, more of a quoted one, or, behind a
#: quote sign in a quoted field, either a second one or the field's end.
NEW, PLAIN, QUOTED, QUOTE = range(4)


def scan(data: bytes, state: int, separator: bytes, breaks: list[int] | None = None) -> int:
    """The state behind ``data``; line breaks outside of quotes are added to ``breaks``.

    A quote sign opens a quoted field at its beginning only, and is doubled inside.
    """
    for at in range(0, len(data), files.CHUNK):
        state = _scan_piece(data[at : at + files.CHUNK], at, state, separator[0], breaks)
    return state


def _scan_piece(data: bytes, offset: int, state: int, separator: int, breaks: list[int] | None) -> int:
    """As :func:`scan`, of the bytes at ``offset``, by runs of quote signs.

    Of a run inside quotes, pairs are signs of the text, and a sign left over ends the field. Outside of
    quotes a run at a field's beginning opens the field and then counts alike, and others are plain text.
    So an odd run at a beginning changes sides, any other odd run leads outside, and even ones change nothing.
    """
    import numpy as np

    codes = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(codes == ord('"'))
    first = np.flatnonzero(np.diff(quotes, prepend=-2) > 1)
    odd = np.diff(first, append=len(quotes)) % 2 == 1
    before = codes[quotes[first] - 1]
    opens = (before == separator) | (before == ord("\n"))
    if data.startswith(b'"'):  # there is no byte before the first run
        opens[0] = state in (NEW, QUOTE)
    # Whether the bytes behind so many runs are inside quotes: by the changes since the last run that led outside.
    changes = np.cumsum(np.append(state == QUOTED, odd & opens))
    left = np.maximum.accumulate(np.append(0, np.where(odd & ~opens, np.arange(1, len(first) + 1), 0)))
    inside = (changes - np.where(left > 0, changes[left], 0)) % 2 == 1
    if breaks is not None:
        lines = np.flatnonzero(codes == ord("\n"))
        outside = ~inside[np.searchsorted(quotes[first], lines)]
        breaks.extend((lines[outside] + offset).tolist())
    if inside[-1]:
        return QUOTED
    if data.endswith(b'"'):
        return QUOTE if opens[-1] or inside[-2] else PLAIN
    return NEW if data[-1] in (separator, ord("\n")) else PLAIN


def _read(path: str, start: int, size: int) -> bytes:
    filesystem, inside = files.open_filesystem(path)
    with filesystem.open_input_file(inside) as file:
        file.seek(start)
        return file.read(size)


def _ends(ranges: DataFrame, separator: bytes) -> DataFrame:
    """(path, number, start, size, ends): the state each range ends in, from each it may begin in."""

    def run(batches):
        for batch in batches:
            ends = []
            for path, start, size in zip(*(batch[c] for c in ("path", "start", "size")), strict=True):
                data = _read(path, start, size)
                if data.startswith(b'"'):
                    ends.append([scan(data, state, separator) for state in (NEW, PLAIN, QUOTED, QUOTE)])
                else:  # the first byte tells all states outside of quotes alike
                    plain = scan(data, PLAIN, separator)
                    ends.append([plain, plain, scan(data, QUOTED, separator), plain])
            yield batch.assign(ends=ends)

    return ranges.select("path", "number", "start", "size").mapInPandas(
        run, "path string, number bigint, start bigint, size bigint, ends array<int>"
    )


def _begun(ends: DataFrame) -> DataFrame:
    """(path, number, start, size, state): the maps composed per file, a few numbers per range."""

    def compose(ranges):
        ranges = ranges.sort_values("number")
        states, state = [], NEW
        for end in ranges["ends"]:
            states.append(state)
            state = int(end[state])
        return ranges[["path", "number", "start", "size"]].assign(state=states)

    return ends.groupBy("path").applyInPandas(compose, "path string, number bigint, start bigint, size bigint, state int")


def _range_records(path: str, number: int, start: int, size: int, state: int, separator: bytes) -> Iterator[bytes]:
    """The records that begin behind a line break of the range, or with the file."""
    filesystem, inside = files.open_filesystem(path)
    with filesystem.open_input_file(inside) as file:
        file.seek(start)
        data = file.read(size)
        breaks: list[int] = []
        state = scan(data, state, separator, breaks)
        begins = ([0] if number == 0 else []) + [b + 1 for b in breaks]
        for begin, stop in zip(begins, breaks if number == 0 else breaks[1:], strict=False):
            yield data[begin:stop]
        if begins:
            rest, beyond = [data[begins[-1] :]], _BEYOND
            while block := file.read(beyond):
                breaks = []
                state = scan(block, state, separator, breaks)
                rest.append(block[: breaks[0]] if breaks else block)
                if breaks:
                    break
                beyond = min(2 * beyond, files.CHUNK)
            yield b"".join(rest)


def records(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], separator: str, encoding: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(record) for every record behind the files' header lines, which must have these names.

    Empty lines are no records, line breaks inside quotes stay as they are. Bytes that are not in the encoding become replacement characters.
    Encodings must write separator, quote sign and line break as the one byte ASCII has for them.
    """
    names, sign = list(names), separator.encode("ascii")

    def run(batches):
        import pandas as pd

        held = []  # ranges may be shorter than what is handed on
        for batch in batches:
            for row in batch.itertuples(index=False):
                first = row.number == 0
                for raw in _range_records(row.path, row.number, row.start, row.size, row.state, sign):
                    raw = raw.removesuffix(b"\r")
                    if not raw.strip():
                        continue
                    text = raw.decode(encoding, "replace")
                    if first:
                        first = False
                        header = next(csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter=separator))
                        if header != names:
                            raise ValueError(f"{row.path}: the header has {header}, not {names}")
                        continue
                    held.append(text)
                    if len(held) == _AT_A_TIME:
                        yield pd.DataFrame({"record": held})
                        held = []
        if held:
            yield pd.DataFrame({"record": held})

    listed = files.list_files(spark, list(paths)).where("length > 0")
    tasks = files.range_tasks(listed, range_bytes)
    begun = _begun(_ends(files.byte_ranges(listed, range_bytes, tasks), sign))
    return begun.repartition(tasks, "path", "number").mapInPandas(run, "record string")


# Tasks carry this module with them, as they do the one that opens files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
