"""BPE encoding over a table of distinct words, decoding through an id-to-piece join.

Documents go to blocks of bounded size (one shuffle of compressed texts). Each block cuts its texts into words and
sends its distinct words, dealt by hash to buckets, to the table; a bucket meets a word once, whatever number of
blocks and documents hold it, encodes it once, and answers every block with the ids in the order of the block's sorted
words. The block joins the ids back by that position, then by the positions of the words in its texts. Only distinct
words per block travel, so a word that makes up a third of the corpus costs one entry per block. Decoding joins each
id with the piece table (as large as the vocabulary) and concatenates in order.

Defined cases: a null text is an empty one; repeated rows are encoded one by one; the special token's string in a text
becomes its id as in the tokenizers library; bytes that are no valid UTF-8 become U+FFFD; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import column_bytes, ship, slices, strings
from trackloom.llm.units import definition, pieces, tokenizer, units

BLOCK_BYTES = 16 << 20
CHUNK_BYTES = 1 << 20
#: distinct words are dealt to at most so many buckets
MOST_BUCKETS = 4_096


def _frame(parts: list[bytes]) -> bytes:
    """Byte strings with their lengths, compressed."""
    sizes = np.array([len(p) for p in parts], np.uint32)
    return pa.compress(np.uint32(len(parts)).tobytes() + sizes.tobytes() + b"".join(parts), "zstd", asbytes=True) + np.uint32(
        4 + sizes.nbytes + int(sizes.sum())
    ).tobytes()


def _unframe(data: bytes) -> list[bytes]:
    raw = pa.decompress(data[:-4], int(np.frombuffer(data[-4:], np.uint32)[0]), "zstd", asbytes=True)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    edges = 4 + 4 * n + np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint32, n, 4))]).astype(int)
    return [raw[a:b] for a, b in zip(edges, edges[1:])]


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _docs(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _sorted_words(texts: list[str], buckets: int) -> dict[int, list[str]]:
    """bucket -> its distinct words in order."""
    words: set[str] = set()
    for t in texts:
        words.update(units(t))
    out: dict[int, list[str]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets, []).append(w)
    return out


def _texts(payloads, text: str) -> list[str]:
    return [s for p in payloads for b in _docs(p).to_batches() for s in strings(b, text)]


def _blocks(docs: DataFrame, text: str, count: int) -> DataFrame:
    """(block INT, payload BINARY): compressed chunks of rows, all columns, dealt to `count` blocks."""

    def run(batches):
        for batch in slices(batches, text, CHUNK_BYTES):
            data = _ipc(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([zlib.crc32(data) % count], pa.int32()), pa.array([data], pa.binary())], ["block", "payload"]
            )

    return docs.mapInArrow(run, "block int, payload binary").repartition(count, "block")


def _answers(blocks: DataFrame, text: str, share, buckets: int) -> DataFrame:
    """(block, bucket, ids BINARY): the ids of each block's words of each bucket, every word encoded once."""

    def ask(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), column_bytes(batch, "payload").to_pylist()):
                held.setdefault(b, []).append(p)
        for b, payloads in held.items():
            words = _sorted_words(_texts(payloads, text), buckets)
            for k in range(0, len(words), 64):
                part = list(words.items())[k : k + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, _ in part], pa.int32()), pa.array([b] * len(part), pa.int32()),
                        pa.array([_frame([w.encode("utf-8", "surrogatepass") for w in ws]) for _, ws in part], pa.binary()),
                    ],
                    ["bucket", "block", "words"],
                )

    def answer(batches):
        t = tokenizer(share.value)
        table: dict[bytes, bytes] = {}
        for batch in batches:
            for bucket, block, framed in zip(*(c.to_pylist() for c in batch.columns)):
                words = _unframe(framed)
                new = [w for w in words if w not in table]
                for w, e in zip(new, t.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in new], add_special_tokens=False)):
                    table[w] = np.array(e.ids, "<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int32()), pa.array([bucket], pa.int32()),
                        pa.array([_frame([table[w] for w in words])], pa.binary()),
                    ],
                    ["block", "bucket", "ids"],
                )

    asked = blocks.mapInArrow(ask, "bucket int, block int, words binary")
    return asked.repartition("bucket").mapInArrow(answer, "block int, bucket int, ids binary")


def block_count(docs: DataFrame, text: str, size: int = BLOCK_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // size))


def _encoded(docs: DataFrame, tokenizer_path: str, key: str, text: str, fields: str, columns, block_bytes: int) -> DataFrame:
    """Cogroup each block with its answers; `columns(ids arrays, piece table)` gives the columns `fields` of its rows."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(key, text)
    share = spark.sparkContext.broadcast(definition(tokenizer_path))
    count = block_count(docs, text, block_bytes)
    buckets = min(MOST_BUCKETS, max(16, count))
    blocks = _blocks(docs, text, count)
    answers = _answers(blocks, text, share, buckets)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {fields}"
    names = [key, *(f.split()[0] for f in fields.split(", "))]

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        payloads = left["payload"].to_pylist()
        words = _sorted_words(_texts(payloads, text), buckets)
        ids_of: dict[str, bytes] = {}
        for bucket, framed in zip(right["bucket"].to_pylist(), right["ids"].to_pylist()):
            ids_of.update(zip(words[bucket], _unframe(framed), strict=True))
        piece = pieces(tokenizer(share.value))
        out = []
        for p in payloads:
            for batch in _docs(p).to_batches():
                ids = [np.frombuffer(b"".join([ids_of[u] for u in units(s)]), "<u4") for s in strings(batch, text)]
                out.append(pa.RecordBatch.from_arrays([batch.column(0), *columns(ids, piece)], names))
        return pa.Table.from_batches(out)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema)


def encode(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(key, ids ARRAY<INT>): one row per row of `docs`."""
    lists = lambda ids, _: [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))]
    return _encoded(docs, tokenizer_path, key, text, "ids array<int>", lists, block_bytes)


def decoded(ids: np.ndarray, piece: list[bytes]) -> bytes:
    """The text of `ids` in UTF-8: each id joined with its piece, in order."""
    raw = b"".join([piece[i] for i in ids.tolist()])
    return raw.decode("utf-8", "replace").encode()


def decode(encodings: DataFrame, tokenizer_path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) of (key, ids): the piece table goes to every task, it is as large as the vocabulary."""
    spark = encodings.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast(pieces(tokenizer(definition(tokenizer_path))))

    def run(batches):
        for batch in batches:
            col = batch.column(1)
            out = [decoded(col[i].values.to_numpy(), share.value).decode() for i in range(len(col))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "text"])

    kind = encodings.schema[key].dataType.simpleString()
    return encodings.select(key, F.coalesce("ids", F.array().cast("array<int>"))).mapInArrow(run, f"`{key}` {kind}, text string")


def round_trip(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(key, n_tokens LONG, ids_sha256, decoded_sha256): digests of the ids and of the text decoded from them."""

    def columns(ids, piece):
        number = [str(i).encode() for i in range(len(piece))]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [
            pa.array([len(i) for i in ids], pa.int64()),
            pa.array([sha(b",".join([number[k] for k in i.tolist()])) for i in ids]),
            pa.array([sha(decoded(i, piece)) for i in ids]),
        ]

    return _encoded(docs, tokenizer_path, key, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns, block_bytes)
