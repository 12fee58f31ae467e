"""Alignment of two tokenizers over a corpus, as Arrow tables in every task and counts merged by Spark.

Every text is encoded by both tokenizers, a space before it. In a slice of texts the id lists are flattened, parent
indices tell each token's document, and a cumulative sum of token lengths, less its document's start, gives the byte
at which a token ends. A hash join on (document, end) finds the ends that both sides share; they cut the tokens into
groups. Equal ids of a group are counted first, then the two sides of a group are joined, so that a group of many equal
tokens is one row; the result is each document's linked id pairs with the number of occurrence pairs.

Slices of one task are put together into blocks of some megabytes. A block keeps its documents' links as places in
its own list of distinct pairs and, per pair, how many of its documents hold it. Spark adds these partial counts up,
finds each first id's highest count, and answers every block with the counts of its pairs; a pair that all blocks hold is
joined in slices. The block then sums up its documents.

Defined cases: a null or empty text, and one that the tokens of either side do not give back byte by byte, has no
tokens; repeated rows are documents of their own and count as such; special tokens' strings are ordinary text; bytes
that are no valid UTF-8 become U+FFFD first; a very long text makes a slice and a block of its own; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import pack, ship, slices, strings, unpack
from trackloom.llm.units import Cache, definition, pieces
from trackloom.operators.skew import salted_join
from trackloom.session import stage

SLICE_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
_SPACE = "▁"
_SUMS = ["n_a", "n_b", "n_groups", "n_links"]


class PieceCache(Cache):
    """A sentencepiece BPE model by its distinct units: a run of spaces and the run of other bytes after it.

    Merges never join a unit with the next one if no piece has a space after another character, which is checked; a
    model with such a piece is given whole texts instead. (U+2581 in a text is a space to the model, and cut otherwise
    here; such a text is not given back byte by byte either way.)
    """

    white = np.zeros(256, bool)
    white[32] = True
    closing = None  # its pieces run from a letter into punctuation

    def __init__(self, model: bytes, most: int = 600_000):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.pieces = [
            bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else n.replace(_SPACE, " ").encode() for i, n in enumerate(names)
        ]
        if any(_SPACE in n.lstrip(_SPACE) for n in names):
            self.white = np.zeros(256, bool)
        self.space = self.sp.piece_to_id(_SPACE)
        self.most, self.known = most, {}

    def _new(self, parts: list[bytes]) -> list[bytes]:
        # the model adds one space itself, and gives nothing at all for no text
        ids = self.sp.encode([p[1:].decode() for p in parts], num_threads=1)
        return [array("I", i if len(p) > 1 else [self.space]).tobytes() for p, i in zip(parts, ids)]


@cache
def _sides(definition_a: str, model_b: bytes) -> tuple[Cache, PieceCache]:
    return Cache(definition_a, plain=True), PieceCache(model_b)


class Side:
    """One tokenizer's vocabulary as Arrow arrays: bytes, lengths, and ids as text before each separator."""

    ENDS = {"a": (",", "|", "|"), "b": (",", ";", "")}  # inside a group, at its end, at the document's end

    def __init__(self, vocabulary: list[bytes], side: str):
        self.bytes = pa.array(vocabulary, pa.binary())
        self.length = pc.binary_length(self.bytes).cast(pa.int64())
        self.size = len(vocabulary)
        self.names = [f"{i}{e}".encode() for e in self.ENDS[side] for i in range(self.size)]


class Aligner:
    """Both tokenizers of a worker, and the alignment of a slice of texts."""

    def __init__(self, definition_a: str, model_b: bytes):
        self.a, self.b = _sides(definition_a, model_b)
        self.side_a, self.side_b = Side(pieces(self.a.t), "a"), Side(self.b.pieces, "b")
        self.names = pa.array(self.side_a.names + self.side_b.names, pa.binary())

    def _tokens(self, raw: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids of each text on both sides; none for texts that they do not give back."""
        texts = [r.decode() for r in raw]
        of_a = self.a.encode(texts)
        flat_b, cuts = self.b.flat(raw)
        of_b = [flat_b[x:y] for x, y in zip(cuts, cuts[1:])]
        given = [self._given(side, ids) for side, ids in ((self.side_a, of_a), (self.side_b, of_b))]
        same = [r == x == y for r, x, y in zip(raw, *given)]
        return tuple(_lists([i if s else i[:0] for i, s in zip(ids, same)]) for ids in (of_a, of_b))

    def _given(self, side: Side, ids: list[np.ndarray]):
        """The bytes that the ids of each text stand for."""
        joined = side.bytes.take(pa.array(np.concatenate([*ids, np.zeros(0, np.uint32)])))
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1]
        data = joined.buffers()[2].to_pybytes() if joined.buffers()[2] else b""
        edges = offsets[np.cumsum([0, *map(len, ids)])] if len(joined) else np.zeros(len(ids) + 1, np.int32)
        return (data[x:y] for x, y in zip(edges, edges[1:]))

    def slice(self, texts: list[str]) -> tuple[dict[str, np.ndarray], pa.Table, list[bytes]]:
        """(sums per text, links (doc, pair, times), groups as text) of some texts."""
        a, b = self._tokens([b" " + t.encode() if t else b"" for t in texts])
        if not len(a.values):
            none = np.zeros(0, np.int64)
            return {n: np.zeros(len(texts), np.int64) for n in _SUMS}, pa.table({"doc": none, "pair": none, "times": none}), [b""] * len(texts)
        ta, tb = _ends(a, self.side_a), _ends(b, self.side_b)
        shared = ta.select(["doc", "end", "at"]).join(tb.select(["doc", "end", "at"]), ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
        last_a, last_b = (np.sort(shared[n].to_numpy()) for n in ("at", "at_b"))
        doc = ta["doc"].to_numpy()[last_a]
        group_a, group_b = (_groups(len(t), last) for t, last in ((ta, last_a), (tb, last_b)))
        links = _links(ta["id"], group_a, tb["id"], group_b, doc, self.side_b.size)
        sums = {
            "n_a": np.diff(a.offsets.to_numpy()), "n_b": np.diff(b.offsets.to_numpy()), "n_groups": np.bincount(doc, minlength=len(texts)),
            "n_links": np.bincount(links["doc"].to_numpy(), links["times"].to_numpy(), len(texts)).astype(np.int64),
        }
        return sums, links, self._written(ta, group_a, last_a, tb, group_b, last_b, doc, len(texts))

    def _written(self, ta, group_a, last_a, tb, group_b, last_b, doc, n: int) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        where = np.zeros(len(ta) + len(tb), np.int64)
        count_a, count_b = (np.bincount(g, minlength=len(doc)) for g in (group_a, group_b))
        place_a = np.arange(len(ta)) + (np.cumsum(count_b) - count_b)[group_a]
        place_b = np.arange(len(tb)) + np.cumsum(count_a)[group_b]
        closes = np.ones(len(doc), np.int64)
        closes[np.flatnonzero(np.append(doc[1:] != doc[:-1], True))] = 2  # the document's last group
        end_a, end_b = np.zeros(len(ta), np.int64), np.zeros(len(tb), np.int64)
        end_a[last_a], end_b[last_b] = 1, closes
        where[place_a] = ta["id"].to_numpy() + end_a * self.side_a.size
        where[place_b] = 3 * self.side_a.size + tb["id"].to_numpy() + end_b * self.side_b.size
        text = self.names.take(pa.array(where))
        data = text.buffers()[2].to_pybytes() if len(where) else b""
        offsets = np.frombuffer(text.buffers()[1], np.int32)[: len(where) + 1] if len(where) else np.zeros(1, np.int32)
        upto = np.cumsum(np.bincount(ta["doc"].to_numpy(), minlength=n) + np.bincount(tb["doc"].to_numpy(), minlength=n))
        edges = offsets[np.concatenate([[0], upto])]
        return [data[x:y] for x, y in zip(edges, edges[1:])]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64)
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32), pa.array(flat))


def _ends(ids: pa.ListArray, side: Side) -> pa.Table:
    """(doc, end, at, id) of every token: its document, the byte in it where it ends, its place."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    upto = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(side.length.take(flat))])
    before = upto.take(ids.offsets.slice(0, len(ids)))  # bytes of all earlier documents
    end = pc.subtract(upto.slice(1), before.take(doc)) if len(flat) else pa.array([], pa.int64())
    return pa.table({"doc": doc, "end": end, "at": pa.array(np.arange(len(flat))), "id": flat})


def _groups(n: int, last: np.ndarray) -> np.ndarray:
    """The group of each of n tokens; `last` are the last ones of the groups."""
    closed = np.zeros(n + 1, np.int64)
    closed[last + 1] = 1
    return np.cumsum(closed)[:n]


def _links(a: pa.ChunkedArray, group_a: np.ndarray, b: pa.ChunkedArray, group_b: np.ndarray, doc: np.ndarray, width: int) -> pa.Table:
    """(doc, pair, times): pair is a * width + b."""
    count = lambda ids, group: pa.table({"group": group, "id": ids}).group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")])
    met = count(a, group_a).join(count(b, group_b), "group", join_type="inner", right_suffix="_b", use_threads=False)
    pair = pc.add(pc.multiply(met["id"], width), met["id_b"])
    times = pc.multiply(met["count_all"], met["count_all_b"])
    every = pa.table({"doc": pa.array(doc).take(met["group"].combine_chunks()), "pair": pair, "times": times})
    out = every.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"])
    return out.take(pa.array(np.argsort(out["doc"].to_numpy(), kind="stable")))


class _Block:
    """What the slices of a block have given so far."""

    def __init__(self):
        self.size, self.keys, self.sums, self.shas, self.links, self.counts = 0, [], [], [], [], []

    def add(self, keys: pa.Array, sums: dict, shas: list[str], links: pa.Table, size: int) -> None:
        self.size += size
        self.keys.append(keys)
        self.sums.append(sums)
        self.shas += shas
        self.counts.append(np.bincount(links["doc"].to_numpy(), minlength=len(keys)))
        self.links.append(links.select(["pair", "times"]))

    def row(self, number: int) -> pa.RecordBatch:
        links = pa.concat_tables(self.links)
        pairs, place, held = np.unique(links["pair"].to_numpy(), return_inverse=True, return_counts=True)
        docs = pack(
            key=pa.concat_arrays(self.keys), groups_sha256=pa.array(self.shas, pa.string()), pairs=np.concatenate(self.counts),
            **{n: np.concatenate([s[n] for s in self.sums]).astype(np.int64) for n in _SUMS},
        )
        packed = [docs, pack(place=place.astype(np.int32), times=links["times"]), pack(pair=pairs, held=held)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([p], pa.binary()) for p in packed)], ["block", "docs", "links", "pairs"])


def _shares(spark, path_a: str, path_b: str):
    with open(path_b, "rb") as f:
        return spark.sparkContext.broadcast((definition(path_a), f.read()))


def blocks(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block LONG, docs, links, pairs BINARY): the aligned corpus, a row per block, written once."""
    ship(docs.sparkSession)
    share = _shares(docs.sparkSession, path_a, path_b)

    def run(batches):
        aligner, block, number = Aligner(*share.value), _Block(), TaskContext.get().partitionId() << 32
        for batch in slices(batches, text, min(SLICE_BYTES, block_bytes)):
            of = strings(batch, text)
            sums, links, written = aligner.slice(of)
            shas = [hashlib.sha256(w).hexdigest() if w else "" for w in written]
            block.add(batch.column(0), sums, shas, links, sum(map(len, of)))
            if block.size >= block_bytes:
                yield block.row(number)
                block, number = _Block(), number + 1
        if block.keys:
            yield block.row(number)

    return stage(docs.select(key, text).mapInArrow(run, "block long, docs binary, links binary, pairs binary"), "aligned")


def _pair_rows(aligned: DataFrame) -> DataFrame:
    """(block, place INT, pair LONG, held LONG): the distinct pairs of every block."""

    def run(batches):
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                p = unpack(data)
                n = len(p["pair"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), p["pair"], p["held"]], ["block", "place", "pair", "held"]
                )

    return aligned.select("block", "pairs").mapInArrow(run, "block long, place int, pair long, held long")


def _counted(rows: DataFrame, width: int) -> DataFrame:
    """(pair, documents LONG, best BOOLEAN): corpus-wide counts; best: no pair of the same first id has a higher one."""
    counts = stage(rows.groupBy("pair").agg(F.sum("held").alias("documents")), "pairs")
    first = F.expr(f"pair div {width}")
    # as many rows as the first vocabulary has ids; a first id has at most as many pairs as the second has
    highest = counts.groupBy(first.alias("first")).agg(F.max("documents").alias("highest"))
    return counts.withColumn("first", first).join(highest, "first").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def _width(path_b: str) -> int:
    with open(path_b, "rb") as f:
        return len(PieceCache(f.read()).pieces)


def pair_table(aligned: DataFrame, path_b: str) -> DataFrame:
    """(a, b INT, documents LONG, best BOOLEAN): the id pairs that `blocks` has linked, each first id's best ones marked."""
    width = _width(path_b)
    found = _counted(_pair_rows(aligned), width)
    return found.select(F.expr(f"int(pair div {width})").alias("a"), F.expr(f"int(pair % {width})").alias("b"), "documents", "best")


def groups(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, groups STRING): every document's groups as `a1,a2|b1;a3|b2,b3`."""
    ship(docs.sparkSession)
    share = _shares(docs.sparkSession, path_a, path_b)

    def run(batches):
        aligner = Aligner(*share.value)
        for batch in slices(batches, text, SLICE_BYTES):
            written = aligner.slice(strings(batch, text))[2]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.decode() for w in written], pa.string())], [key, "groups"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, groups string")


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: (key, n_a, n_b, n_groups, n_links, n_best, count_sum LONG, groups_sha256).

    The groups' digest is taken where they are made, since as text they are several times the corpus.
    """
    aligned = blocks(docs, path_a, path_b, key, text, block_bytes)
    rows = _pair_rows(aligned)
    rated = stage(_counted(rows, _width(path_b)), "pairs")
    answers = salted_join(rows.drop("held"), rated, ["pair"], ["block"]).drop("pair")
    kind = docs.schema[key].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["place"].to_numpy())
        documents, best = right["documents"].to_numpy()[order], right["best"].to_numpy()[order]
        out = []
        for of, data in zip(left["docs"].to_pylist(), left["links"].to_pylist()):
            d, links = unpack(of), unpack(data)
            place, times = links["place"].to_numpy(), links["times"].to_numpy()
            edges = np.concatenate([[0], np.cumsum(d["pairs"].to_numpy())])
            upto = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[edges])
            sums = [pa.array(upto(times * best[place]), pa.int64()), pa.array(upto(times * documents[place]), pa.int64())]
            out.append(pa.table([d["key"], *(d[n] for n in _SUMS), *sums, d["groups_sha256"]], [key, *_SUMS, "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(out)

    fields = ", ".join(f"{n} long" for n in [*_SUMS, "n_best", "count_sum"])
    met = aligned.select("block", "docs", "links").groupBy("block").cogroup(answers.groupBy("block"))
    return met.applyInArrow(run, f"`{key}` {kind}, {fields}, groups_sha256 string")
