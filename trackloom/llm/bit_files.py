"""Token ids in fixed-width bit-packed files, written and read in id order.

Format of one file (all numbers little-endian): 16 bytes of header (magic, bits per id, ids per block), the blocks,
then per document its start (64 bits, ids before it in this file), the block offsets (64 bits each), and a trailer
with the counts and the offset of the tables. A block holds `BLOCK` ids in `bits` bits each, bit 0 first, so id k of
the file is in block k // BLOCK and any range is unpacked with a few vectorised shifts. Files are written inside
tasks under names of their own; only those named in the manifest count, so a task that is run again does no harm.

Defined cases: a null text is empty and holds the end id alone; equal keys are ordered by their texts; null keys come
first; an empty table gives an empty manifest; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import ship, slices, strings
from trackloom.llm.units import definition, tokenizer, worker_cache
from trackloom.session import shared_dir, stage

_HEAD = struct.Struct("<8sII")
_TAIL = struct.Struct("<QQQQ8s")
_MAGIC = b"TLBITS01"
BLOCK = 1 << 16
_LANES = 64  # ids that together fill whole 64-bit words


def pack(ids: np.ndarray, bits: int) -> bytes:
    """`ids` in `bits` bits each, padded to a multiple of 64 ids."""
    padded = np.zeros(-(-len(ids) // _LANES) * _LANES, np.uint64)
    padded[: len(ids)] = ids
    lanes = padded.reshape(-1, _LANES)
    words = np.zeros((len(lanes), bits), np.uint64)
    for k in range(_LANES):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    out = np.empty((len(words), _LANES), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for k in range(_LANES):
        word, shift = divmod(k * bits, 64)
        got = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            got = got | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, k] = got & mask
    return out.reshape(-1)[:count].astype(np.uint32)


class Writer:
    """Streams documents' ids into one file; memory holds one block of ids and one number per document."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.starts: list[int] = []
        self.offsets: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0
        out.write(_HEAD.pack(_MAGIC, bits, block))
        self.at = _HEAD.size

    def add(self, ids: np.ndarray) -> None:
        self.starts.append(self.total)
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // self.block * self.block
        for s in range(0, whole, self.block):
            data = pack(ids[s : min(s + self.block, whole)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array(self.starts, "<u8").tobytes() + np.array(self.offsets, "<u8").tobytes())
        self.out.write(_TAIL.pack(self.total, len(self.starts), len(self.offsets), self.at, _MAGIC))


class Reader:
    """Random access to a file's documents. `source` is a seekable file, `size` its length."""

    def __init__(self, source, size: int):
        self.source = source
        magic, self.bits, self.block = _HEAD.unpack(self._bytes(0, _HEAD.size))
        self.total, docs, n_blocks, at, end = _TAIL.unpack(self._bytes(size - _TAIL.size, _TAIL.size))
        if magic != _MAGIC or end != _MAGIC:
            raise ValueError("not a bit-packed id file, or cut short")
        tables = np.frombuffer(self._bytes(at, 8 * (docs + n_blocks)), "<u8")
        self.starts = np.append(tables[:docs], np.uint64(self.total)).astype(np.int64)
        self.offsets = np.append(tables[docs:], np.uint64(at)).astype(np.int64)

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids(self, first: int, end: int) -> np.ndarray:
        """The ids [first, end) of the file; only their blocks are read."""
        if end <= first:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, (end - 1) // self.block
        data = self._bytes(int(self.offsets[a]), int(self.offsets[b + 1] - self.offsets[a]))
        base = a * self.block
        return unpack(data, self.bits, min((b + 1) * self.block, self.total) - base)[first - base : end - base]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def _open(path: str, mode: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    if mode == "w":
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(name), 0
    return system.open_input_file(name), system.get_file_info(name).size


def write(
    docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """Encode every text, append `end_id`, write the ids in key order; the manifest: one row per file.

    (part INT, path, n_docs, n_tokens, start LONG: ids in all files before, keys ARRAY). The folder must be one that
    pyarrow can open from every executor; left out, it is a new one in the shared folder.
    """
    spark = docs.sparkSession
    ship(spark)
    text_json = definition(tokenizer_path)
    t = tokenizer(text_json)
    bits = max(1, max(t.get_vocab_size() - 1, end_id).bit_length())
    share = spark.sparkContext.broadcast(text_json)
    folder = folder or f"{shared_dir(spark)}/trackloom/ids-{uuid.uuid4().hex}"
    kind = docs.schema[key].dataType

    def run(batches):
        from pyspark import TaskContext

        cache = worker_cache(share.value)
        out, keys, number = None, [], TaskContext.get().partitionId()
        end = np.uint32(end_id)
        for batch in slices(batches, text, 2 << 20):
            if out is None:
                path = f"{folder}/part-{number:06d}-{uuid.uuid4().hex}.bits"
                stream, _ = _open(path, "w")
                out = Writer(stream, bits)
            for ids in cache.encode(strings(batch, text)):
                out.add(np.append(ids, end))
            keys.append(batch.column(0))
        if out is not None:
            out.close()
            stream.close()
            lists = pa.ListArray.from_arrays([0, sum(map(len, keys))], pa.concat_arrays(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()), pa.array([path]), pa.array([len(out.starts)], pa.int64()),
                    pa.array([out.total], pa.int64()), lists,
                ],
                ["part", "path", "n_docs", "n_tokens", "keys"],
            )

    # dealt by ranges of (key, text digest), so ties can lie in two files and still be in order
    ranges = docs.select(key, text, F.xxhash64(text).alias("_tie")).repartitionByRange(key, "_tie")
    ordered = ranges.sortWithinPartitions(key, "_tie", text).select(key, text)
    files = ordered.mapInArrow(run, f"part int, path string, n_docs long, n_tokens long, keys array<{kind.simpleString()}>")
    files = stage(files, "ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one small row per file
    starts = files.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("start"))
    return files.join(starts, "part")


def read(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start LONG, ids ARRAY<LONG>): every document, read back from the files."""
    return _each(manifest, key, "ids array<long>", lambda parts: [pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))])


def digests(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32 LONG): every document, read back; crc32 over 32-bit little-endian ids."""
    import zlib

    def columns(parts):
        crc = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
        return [pa.array([len(p) for p in parts], pa.int64()), pa.array(crc, pa.int64())]

    return _each(manifest, key, "n_tokens long, ids_crc32 long", columns)


def _each(manifest: DataFrame, key: str, fields: str, columns) -> DataFrame:
    ship(manifest.sparkSession)
    kind = manifest.schema["keys"].dataType.elementType.simpleString()
    names = [key, "start", *(f.split()[0] for f in fields.split(", "))]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = batch.column(0)[i].values
                base = batch.column(2)[i].as_py()
                source, size = _open(batch.column(1)[i].as_py(), "r")
                with source:
                    file = Reader(source, size)
                    k = 0
                    while k < len(keys):
                        # so many documents at a time as hold about 16 blocks
                        e = max(k + 1, int(np.searchsorted(file.starts, file.starts[k] + 16 * file.block, "right")) - 1)
                        e = min(e, len(keys))
                        ids = file.ids(int(file.starts[k]), int(file.starts[e]))
                        cuts = file.starts[k : e + 1] - file.starts[k]
                        parts = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [keys.slice(k, e - k), pa.array(file.starts[k:e] + base), *columns(parts)], names
                        )
                        k = e

    # a task per file, whatever small files the manifest itself was written in
    m = manifest.select("keys", "path", "start").repartition(max(1, manifest.count()), "path")
    return m.mapInArrow(run, f"`{key}` {kind}, start long, {fields}")
