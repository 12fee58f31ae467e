"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: words split at ASCII white space, A-Z lower-cased, `shingle`-word shingles with repeats, XXH64 with seed
42 of each, a bit is 1 if more than half of the hashes have it. Distinct fingerprints are filed in tiles by the
population counts of their two halves. Two fingerprints that differ in at most `radius` bits have counts that differ
by at most `radius` in sum, so a tile meets only tiles within that distance; all other tile pairs are skipped. In a
large tile pair the same bound on the four quarters skips runs within the tiles. What is left goes through numpy's
exclusive or and bit counts. A task returns the spanning forest of what it linked, never all pairs, so a group of n
near copies costs n rows.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; fewer than `shingle` words
are one shingle; equal texts have equal fingerprints and one class; a null id never becomes a class id unless a
class has no other; extra columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import column_bytes, fresh, ship, slices, split_by_ids, texts
from trackloom.operators.graph import components
from trackloom.session import stage

_HALVES = 2
_RADIX = 128  # room for a half's count (0-32) plus the radius on both sides
TILE = 16_384
_SQUARE = 1_024


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    h = xxhash.xxh64_intdigest
    return [h(joined[a : b - 1], 42) for a, b in zip(starts, ends[shingle - 1 :])]


def fingerprints_of(docs: list[bytes], shingle: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    each = [shingle_hashes(t, shingle) for t in docs]
    out = np.zeros(len(docs), np.uint64)
    some = [i for i, h in enumerate(each) if h]
    if some:
        n = np.array([len(each[i]) for i in some])
        flat = np.fromiter((x for i in some for x in each[i]), np.uint64, int(n.sum()))
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0, dtype=np.int32)
        out[some] = np.packbits(ones * 2 > n[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(key, fp LONG): the fingerprint's 64 bits as a signed number."""
    ship(docs.sparkSession)
    docs = docs.select(key, text)

    def run(batches):
        for batch in slices(batches, text):
            fp = fingerprints_of(texts(batch, text), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], [key, "fp"])

    return docs.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fp long")


class Forest:
    """Union-find over positions; vectorised lookups, few unions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while True:
            further = self.up[r]
            if np.array_equal(further, r):
                self.up[at] = r
                return r
            r = further

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        ra, rb = self.roots(a), self.roots(b)
        apart = ra != rb
        if apart.any():
            for x, y in np.unique(np.stack([ra[apart], rb[apart]], axis=1), axis=0):
                x, y = self.roots(np.array([x, y]))
                self.up[max(x, y)] = min(x, y)


def _profile(f: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, one row per fingerprint."""
    return np.stack([np.bitwise_count(f >> np.uint64(16 * q) & np.uint64(0xFFFF)) for q in range(4)], axis=1).astype(np.int16)


def _runs(f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, start of each run of equal profiles and the end, profile of each run)."""
    p = _profile(f)
    order = np.lexsort(p.T)
    p = p[order]
    cuts = np.flatnonzero((p[1:] != p[:-1]).any(axis=1)) + 1
    return order, np.concatenate([[0], cuts, [len(f)]]), p[np.concatenate([[0], cuts])]


def forest_of_pair(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) that span everything within `radius` between two tiles; `same`: they are one tile."""
    both = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    forest = Forest(len(both))

    def square(ia: np.ndarray, jb: np.ndarray) -> None:
        x, y = np.nonzero(np.bitwise_count(a[ia][:, None] ^ b[jb][None, :]) <= radius)
        forest.link(ia[x], jb[y] + shift)

    if len(a) * len(b) <= _SQUARE**2:
        square(np.arange(len(a)), np.arange(len(b)))
    else:  # tiles within the tile: runs of equal quarter counts, skipped by the same bound
        oa, ea, pa_ = _runs(a)
        ob, eb, pb = (oa, ea, pa_) if same else _runs(b)
        for i in range(len(pa_)):
            close = np.flatnonzero(np.abs(pb - pa_[i]).sum(axis=1) <= radius)
            for j in close[close >= i] if same else close:
                for s in range(ea[i], ea[i + 1], _SQUARE):
                    for t in range(eb[j], eb[j + 1], _SQUARE):
                        square(oa[s : min(s + _SQUARE, ea[i + 1])], ob[t : min(t + _SQUARE, eb[j + 1])])
    every = np.arange(len(both))
    roots = forest.roots(every)
    moved = roots != every
    return both[moved], both[roots[moved]]


def near_links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(a LONG, b LONG): links that connect exactly what chains of fingerprints within `radius` bits connect.

    `distinct` holds one row per fingerprint in column fp.
    """
    ship(distinct.sparkSession)
    half = [F.bit_count(F.shiftrightunsigned("fp", 32 * q).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))) for q in range(_HALVES)]
    cell = sum((half[q] + radius) * _RADIX**q for q in range(_HALVES)).cast("long")

    def tiles(batches):
        cells, fps = [], []
        for batch in batches:
            cells.append(batch.column(0).to_numpy())
            fps.append(batch.column(1).to_numpy())
        if cells:
            c, f = np.concatenate(cells), np.concatenate(fps)
            order = np.lexsort((f, c))
            c, f = c[order], f[order]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(c)) + 1, [len(c)]])
            cuts = [
                (s, min(s + tile, e)) for lo, e in zip(edges, edges[1:]) for s in range(int(lo), int(e), tile)
            ]
            for k in range(0, len(cuts), 256):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(c[s]) for s, _ in cuts[k : k + 256]], pa.int64()),
                        pa.array([int(f[s]) for s, _ in cuts[k : k + 256]], pa.int64()),
                        pa.array([f[s:e].tobytes() for s, e in cuts[k : k + 256]], pa.binary()),
                    ],
                    ["cell", "tile", "fps"],
                )

    t = distinct.select(cell.alias("cell"), "fp").repartition("cell").mapInArrow(tiles, "cell long, tile long, fps binary")
    # of the two directions between cells only the one to the larger cell number is taken
    steps = [
        d for d in (
            sum(x * _RADIX**q for q, x in enumerate(v))
            for v in product(range(-radius, radius + 1), repeat=_HALVES)
            if sum(map(abs, v)) <= radius
        ) if d >= 0
    ]
    visits = t.select(
        F.explode(F.transform(F.array(*[F.lit(d).cast("long") for d in steps]), lambda d: d + F.col("cell"))).alias("at"),
        F.col("cell").alias("from"), F.col("tile").alias("tile_a"), F.col("fps").alias("fps_a"),
    )
    pairs = visits.join(t.select(F.col("cell").alias("at"), "tile", "fps"), "at").where(
        "`from` < at or tile_a <= tile"
    )

    def compare(batches):
        for batch in batches:
            xs, ys = [], []
            fa, fb = column_bytes(batch, "fps_a"), column_bytes(batch, "fps")
            same = batch.column(batch.schema.get_field_index("same")).to_pylist()
            for a, b, s in zip(fa, fb, same):
                x, y = forest_of_pair(
                    np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), radius, s
                )
                if len(x):
                    xs.append(x)
                    ys.append(y)
            if xs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(xs).view(np.int64)), pa.array(np.concatenate(ys).view(np.int64))], ["a", "b"]
                )

    pairs = pairs.select("fps_a", "fps", F.expr("`from` = at and tile_a = tile").alias("same"))
    return pairs.mapInArrow(compare, "a long, b long")


def near_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, tile: int = TILE
) -> DataFrame:
    """(key, fp LONG, component_id): the smallest key that chains of near fingerprints reach; one row per row of docs."""
    prints = stage(fingerprints(docs, key, text, shingle), "simhash")
    distinct = stage(prints.groupBy("fp").agg(F.min(key).alias("first")), "simhash")
    links = stage(near_links(distinct, radius, tile), "simhash")
    linked = links.select(F.col("a").alias("fp")).union(links.select(F.col("b").alias("fp"))).distinct()
    root = stage(components(linked, links, "fp", "a", "b"), "simhash")
    classed = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    first = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    # written, so that a class with a third of all documents is a skewed join of two inputs, which Spark splits
    to = stage(classed.select("fp", "root").join(first, "root").select("fp", "component_id"), "simhash")
    return prints.join(to, "fp").select(key, "fp", "component_id")


def drop_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """The documents, all columns, without those whose class has a smaller key; rows that repeat a key are judged by text."""
    prints = near_classes(docs, key, text, shingle, radius)
    later = F.coalesce(F.col(key) != F.col("component_id"), F.lit(False))
    gone, at, identity, cut = (fresh(docs, n) for n in ("gone_key", "gone_fp", "gone_row", "gone_cut"))
    prints = stage(prints.select(F.col(key).alias(gone), F.col("fp").alias(at), later.alias("later")), "simhash")
    fate = prints.groupBy(gone).agg(F.max("later").alias("some"), F.min("later").alias("all"))
    fate = stage(fate.where("some").select(gone, "all"), "simhash")
    asked, sure = split_by_ids(docs, key, fate.select(gone))
    clear = asked.join(fate.select(gone), F.col(key) == F.col(gone), "left_anti")
    # ids on several texts of which some go: the row's own fingerprint decides
    mixed = fate.where("not all").select(gone)
    place = F.struct(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
    rows = asked.join(mixed, F.col(key) == F.col(gone), "left_semi").withColumn(identity, place)
    drop = fingerprints(rows, identity, text, shingle).join(
        prints.where("later"), (F.col(f"`{identity}`.id") == F.col(gone)) & (F.col("fp") == F.col(at)), "left_semi"
    )
    kept = rows.join(drop.select(F.col(identity).alias(cut)), F.col(identity) == F.col(cut), "left_anti").drop(identity)
    return sure.unionByName(clear).unionByName(kept)
