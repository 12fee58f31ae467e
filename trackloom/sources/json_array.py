"""JSON array files of any size, read by many tasks, and a writer of such files.

Where an element begins depends on everything before it: whether a string is open, whether its next byte is escaped, and
how deep brackets are nested. Every byte range is first summarised as a function of the state in front of it (outside
strings, in a string, in a string after a backslash): the state behind it and the change of depth. The summaries, a small
row per range, are composed in order of the ranges, which gives each range its true entry state. Then each range cuts
out the elements that begin in it, reading on where the last one ends in a later range, and the elements are parsed
as rows of their own.

Defined cases: an empty array has no rows; white space around and between elements is skipped; elements are any JSON
values, those that do not fit the schema become null rows as in Spark's reader; a file that is no array, or is cut
short, raises an error that names it; bytes behind the array must be white space; a byte order mark is skipped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trackloom.session import stage
from trackloom.sources.recording import filesystem

RANGE_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20
TASK_BYTES = 64 << 20
AHEAD_BYTES = 4 << 10  # read behind a range at first, for the end of its last element
OUTSIDE, INSIDE, ESCAPED = range(3)

_DEPTH = np.zeros(256, np.int64)
_DEPTH[list(b"[{")], _DEPTH[list(b"]}")] = 1, -1
_BLANK = b" \t\r\n"


class Block:
    """A piece of JSON text, for one state in front of it."""

    def __init__(self, data: bytes, state: int):
        flat = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(flat == 92)  # backslashes stand in strings only
        escaped = np.zeros(len(flat) + 1, bool)
        if state == ESCAPED and len(flat):
            escaped[0] = True
        if len(at):
            # of a run of backslashes every second one escapes what follows; a run that begins escaped is shifted by one
            first = np.concatenate([[True], np.diff(at) > 1])
            start = at[first]
            place = at - np.repeat(start, np.diff(np.append(np.flatnonzero(first), len(at)))) + np.repeat(
                escaped[start], np.diff(np.append(np.flatnonzero(first), len(at)))
            )
            escaped[at[place % 2 == 0] + 1] = True
        quote = (flat == 34) & ~escaped[:-1]
        self.flat = flat
        self.outside = (np.cumsum(quote) - quote + (state != OUTSIDE)) % 2 == 0
        self.outside &= ~quote
        odd = (int(quote.sum()) + (state != OUTSIDE)) % 2
        self.state = (ESCAPED if escaped[-1] else INSIDE) if odd else OUTSIDE
        if not len(flat):
            self.state = state
        self.change = np.where(self.outside, _DEPTH[flat], 0)

    def edges(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(places where an element may begin after them, places that end one) given the depth in front."""
        after = depth + np.cumsum(self.change)
        comma = self.outside & (self.flat == 44) & (after == 1)
        opens = (self.change == 1) & (after == 1)
        closes = (self.change == -1) & (after == 0)
        return np.flatnonzero(comma | opens), np.flatnonzero(comma | closes)


class _File:
    def __init__(self, path: str):
        system, name = filesystem(path)
        self.path, self.file = path, system.open_input_file(name)

    def blocks(self, start: int, end: int, size: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
        for at in range(start, end, size):
            self.file.seek(at)
            yield at, self.file.read(min(size, end - at))

    def onwards(self, start: int, end: int, size: int, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
        """Blocks of [start, end), then, as long as they are asked for, small ones that grow up to the file's `size`."""
        yield from self.blocks(start, end, block)
        at, step = end, min(block, AHEAD_BYTES)
        while at < size:
            yield from self.blocks(at, min(size, at + step), step)
            at, step = at + step, min(block, 2 * step)


def summary(blocks: Iterator[bytes]) -> list[tuple[int, int]]:
    """(state behind, change of depth) for each state in front."""
    now = [(s, 0) for s in (OUTSIDE, INSIDE, ESCAPED)]
    for data in blocks:
        one = [Block(data, s) for s in (OUTSIDE, INSIDE, ESCAPED)]
        now = [(one[s].state, d + int(one[s].change.sum())) for s, d in now]
    return now


def elements(path: str, size: int, start: int, end: int, state: int, depth: int, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the elements that begin in [start, end), given what is in front of it."""
    source = _File(path)
    begin, parts, last = None, [], depth
    for at, data in source.onwards(start, end, size, block):
        if begin is None and at >= end:
            return
        b = Block(data, state)
        if at < end:
            upto = min(end - at, len(data))
            _check(path, b, depth, at, upto)
            for place in np.flatnonzero((b.change[:upto] == 1) & (depth + np.cumsum(b.change[:upto]) == 1)).tolist():
                # nothing but white space and a byte order mark stands before the array
                if b"".join(d for _, d in source.blocks(0, at + place)).removeprefix(b"\xef\xbb\xbf").strip(_BLANK):
                    raise ValueError(f"{path}: not a JSON array, or more than one")
        starts, ends = b.edges(depth)
        state, depth = b.state, depth + int(b.change.sum())
        begins, stops = set(starts[starts + at < end].tolist()), set(ends.tolist())
        for place in sorted(begins | stops):
            if begin is not None and place in stops:
                text = b"".join([*parts, data[max(0, begin - at) : place]]).strip(_BLANK)
                if text:
                    yield begin, text
                begin, parts = None, []
            if place in begins:
                begin = at + place + 1
        if begin is not None:
            parts.append(data[max(0, begin - at) :])
    if begin is not None or last < 0:
        raise ValueError(f"{path}: the array is cut short")


def _check(path: str, block: Block, depth: int, at: int, upto: int) -> None:
    """Only white space may stand outside the array; it must be an array, and one."""
    after = depth + np.cumsum(block.change)
    outer = np.flatnonzero((after[:upto] - np.minimum(block.change[:upto], 0)) == 0)
    stray = [i for i in outer[~np.isin(block.flat[outer], list(_BLANK))].tolist() if not (at + i < 3 and block.flat[i] >= 128)]
    if stray or (after[:upto] < 0).any() or ((after[:upto] == 1) & (block.change[:upto] == 1) & (block.flat[:upto] != 91)).any():
        raise ValueError(f"{path}: not a JSON array, or more than one")


def _files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the file or of the JSON files of a folder."""
    system, name = filesystem(path)
    scheme = f"{path.split('://')[0]}://" if "://" in path else ""
    info = system.get_file_info(name)
    found = [info] if info.is_file else [i for i in system.get_file_info(fs.FileSelector(name, recursive=True)) if i.path.endswith(".json")]
    return sorted((scheme + i.path, i.size) for i in found if i.is_file)


def entries(ranges: DataFrame) -> DataFrame:
    """(path, size, first, last, state, depth): the ranges with the state and depth in front of each."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for s, (state, change) in enumerate(summary(d for _, d in _File(r["path"]).blocks(r["first"], r["last"]))):
                    rows.append({**r, "before": s, "after": state, "change": change})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*batch.schema, ("before", pa.int32()), ("after", pa.int32()), ("change", pa.int64())]))

    fields = "path string, size long, first long, last long"
    parts = ranges.mapInArrow(summarise, f"{fields}, before int, after int, change long")

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["first"], r["before"]))
        out, state, depth = [], OUTSIDE, 0
        for k in range(0, len(rows), 3):
            r = rows[k + state]
            out.append({n: r[n] for n in ("path", "size", "first", "last")} | {"state": state, "depth": depth})
            state, depth = r["after"], depth + r["change"]
        if state != OUTSIDE or depth:
            raise ValueError(f"{rows[0]['path']}: the array is cut short")
        kinds = [("path", pa.string()), ("size", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("state", pa.int32()), ("depth", pa.int64())]
        return pa.Table.from_pylist(out, pa.schema(kinds))

    # three small rows per range of a file
    return parts.groupBy("path").applyInArrow(compose, f"{fields}, state int, depth long")


def read_elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, at LONG, value STRING): the text of every element of the array file, or of all in a folder."""
    found = [f for f in _files(path) if f[1]]
    files = spark.createDataFrame(found, "path string, size long")
    n = F.expr(f"(size - 1) div {range_bytes}")
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("k")).select(
        "path", "size", (F.col("k") * range_bytes).alias("first"), F.least(F.col("size"), (F.col("k") + 1) * range_bytes).alias("last")
    )
    # a number of its own: the rows are small, and the runtime would put them all into one task
    tasks = min(sum(-(-size // range_bytes) for _, size in found), max(4 * spark.sparkContext.defaultParallelism, sum(size for _, size in found) // TASK_BYTES))
    spread = lambda df: df.repartition(max(1, tasks), "path", "first")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at, values, held = [], [], 0
                for place, text in elements(r["path"], r["size"], r["first"], r["last"], r["state"], r["depth"]):
                    at.append(place)
                    values.append(text)
                    held += len(text)
                    if held >= 1 << 20:
                        yield _elements(r["path"], at, values)
                        at, values, held = [], [], 0
                yield _elements(r["path"], at, values)

    return spread(stage(entries(spread(ranges)), "ranges")).mapInArrow(cut, "path string, at long, value string")


def _elements(path: str, at: list[int], values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(values, pa.binary()).cast(pa.string())], ["path", "at", "value"])


def read(spark: SparkSession, path: str, schema: StructType | str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The elements of array files as rows of `schema`."""
    return read_elements(spark, path, range_bytes).select(F.from_json("value", schema).alias("r")).select("r.*")


def write(df: DataFrame, folder: str) -> DataFrame:
    """One array file per task, an element a row; (path, rows) of the files that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}.json"
        system, name = filesystem(path)
        out, n = None, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if out is None:
                    system.create_dir(os.path.dirname(name), recursive=True)
                    out = system.open_output_stream(name)
                out.write((b",\n  " if n else b"[\n  ") + text.encode())
                n += 1
        if out is not None:
            out.write(b"\n]\n")
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "rows": [n]})

    return df.select(F.to_json(F.struct(*df.columns))).mapInArrow(run, "path string, rows long")
