"""Batch helpers shared by the text operators: slicing Arrow batches, byte-level words, hashed words, shipping code."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.session import stage

#: bytes of text one slice may hold; a longer single text is a slice of its own
SLICE_BYTES = 1 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so they need no shared installation."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, package)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(key: str, mod: int) -> Column:
    """crc32 of the id as text, modulo `mod`: the fold of a labelled row."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % mod


def column_bytes(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string or binary column as binary, without a copy."""
    col = batch.column(batch.schema.get_field_index(name))
    return col if pa.types.is_binary(col.type) else col.cast(pa.binary())


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about `limit` bytes together."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column_bytes(batch, text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [b or b"" for b in column_bytes(batch, name).to_pylist()]


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts as str; null is empty, invalid bytes become U+FFFD."""
    return [b.decode("utf-8", "replace") for b in texts(batch, name)]


ASCII_WHITE = np.zeros(256, bool)
ASCII_WHITE[[32, *range(9, 14)]] = True

_powers: dict[str, np.ndarray] = {}
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64


def _power_table(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        factors = np.full(1 << max(n - 1, SLICE_BYTES).bit_length(), base % 2**64, np.uint64)
        factors[0] = 1
        have = _powers[kind] = np.cumprod(factors, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_words(docs: list[bytes], first: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of every white-space separated word, first word of each document, first word of each line).

    Both lists end with the number of words; an empty line has the first word of the next. `first`: only so many bytes
    of each word are hashed, a stem that inflected or coined words share. One pass over the joined
    bytes: prefix sums of byte x base^position give any word's polynomial hash as a difference, moved back to
    position zero with the base's inverse.
    """
    flat = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
    white = ASCII_WHITE[flat]
    before = np.empty_like(white)
    before[0], before[1:] = True, white[:-1]
    starts = np.flatnonzero(before & ~white)
    ends = np.flatnonzero(white & ~before)
    if first is not None:
        ends = np.minimum(ends, starts + first)
    words = mix(span_hashes((flat.astype(np.uint64) + np.uint64(1)), starts, ends))
    edges = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    lines = np.concatenate([[0], np.flatnonzero(flat == 10) + 1])
    return words, np.searchsorted(starts, edges), np.searchsorted(starts, lines)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of each run values[start:end]; equal runs have equal hashes wherever they stand."""
    up = _power_table("up", int(_BASE), len(values) + 1)
    down = _power_table("down", pow(int(_BASE), -1, 2**64), len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


#: positions of the filter below: 2**24 bits are 262,144 words of 64, the most that is broadcast
FILTER_BITS = 24


def split_by_ids(docs: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the ids, rows whose key surely is not); `ids` has one column.

    The hashes of the ids set bits of a table of fixed size, which is broadcast, so that only the first part has to
    be shuffled for a join with the ids. With very many ids the first part grows towards all rows; no row is lost.
    """
    name = ids.columns[0]
    bit = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    word, mask = fresh(docs, "filter_word"), fresh(docs, "filter_mask")
    at = bit(F.col(name))
    low = lambda c: c.bitwiseAND(F.lit(63).cast("long")).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), low(at))
    masks = ids.where(F.col(name).isNotNull()).groupBy(F.shiftright(at, 6).alias(word)).agg(F.bit_or(one).alias(mask))
    masks = stage(masks, "filter")
    here = bit(F.col(key))
    marked = docs.join(F.broadcast(masks), F.shiftright(here, 6) == F.col(word), "left")
    set_ = F.call_function("shiftright", F.col(mask), low(here)).bitwiseAND(F.lit(1).cast("long")) == 1
    may = F.coalesce(set_, F.lit(False))
    return marked.where(may).select(*docs.columns), marked.where(~may).select(*docs.columns)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """`docs` joined with at most `most` of the labelled ids, chosen by the ids' hash; column `label` is added.

    The chosen ids are bounded by `most`, so they are broadcast and no text is shuffled.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, F.col(label).cast("double").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64(key), "_label").limit(most)
    return docs.join(F.broadcast(chosen), key)


def pack(**columns) -> bytes:
    """Columns of equal length as one compressed Arrow table."""
    sink = pa.BufferOutputStream()
    table = pa.table(columns)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> dict[str, pa.Array]:
    """The columns of a packed table."""
    table = pa.ipc.open_stream(data).read_all()
    return {n: table[n].combine_chunks() for n in table.column_names}


def widen(table: pa.Schema, *more: tuple[str, pa.DataType]) -> pa.Schema:
    """`table` with further fields."""
    for name, kind in more:
        table = table.append(pa.field(name, kind))
    return table
