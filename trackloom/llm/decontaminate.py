"""Benchmark decontamination by a prefix-filtered set join, verified word by word.

Every item becomes windows of `window` consecutive words (a shorter item is one window). The tokens of a window are
ordered by rarity in the corpus; for full containment the necessary prefix is the single rarest token, so a document
can only hold the window around a place where that token stands. Position and length bounds discard places too near
an end, and the rest is compared exactly. Windows come in blocks of bounded size, each block sent to all tasks.

Defined cases: null or wordless texts have no words and no hits; an item without words is no window; null item ids
are not listed; items with equal windows are all listed; repeated rows are answered one by one; an empty benchmark
leaves every document clean; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ship, slices, texts

#: A-Z to a-z; 0-9, a-z and all bytes above 0x7F are words, the rest separates
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, words): each item's windows, words joined by spaces."""

    def cut(batches):
        for batch in slices(batches, text):
            ids, grams = [], []
            names = batch.column(batch.schema.get_field_index(item)).to_pylist()
            for name, t in zip(names, texts(batch, text)):
                w = words_of(t)
                found = {b" ".join(w[i : i + window]) for i in range(max(1, len(w) - window + 1))} if w else ()
                ids += [name] * len(found)
                grams += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(grams, pa.binary())], ["item", "gram"])

    b = benchmark.select(F.col(item).cast("string").alias(item), text)
    return b.mapInArrow(cut, "item string, gram binary").distinct()


def _rarity(docs: DataFrame, text: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the vocabulary stands; the vocabulary is one block's, so it is bounded."""
    share = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        seen: Counter[bytes] = Counter()
        for batch in slices(batches, text):
            for t in texts(batch, text):
                seen.update(share.value.intersection(words_of(t)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
        )

    rows = docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def _prefix_index(pairs: list[tuple[str | None, bytes]], rarity: dict[bytes, int]) -> dict:
    """rarest word -> [(its place in the window, the window's words, items)]."""
    items: dict[bytes, list[str]] = {}
    for name, gram in pairs:
        items.setdefault(gram, []).append(name)
    index: dict[bytes, list] = {}
    for gram, names in items.items():
        w = gram.split(b" ")
        rare = min(range(len(w)), key=lambda i: (rarity.get(w[i], 0), w[i]))
        index.setdefault(w[rare], []).append((rare, w, sorted({n for n in names if n is not None})))
    return index


def hits(words: list[bytes], index: dict) -> tuple[list[int], list[str]]:
    """(positions of words inside an occurring window, items of these windows), both sorted and distinct."""
    inside: set[int] = set()
    items: set[str] = set()
    for at in [i for i, w in enumerate(words) if w in index]:
        for place, window, names in index[words[at]]:
            first = at - place
            if first >= 0 and first + len(window) <= len(words) and words[first : first + len(window)] == window:
                inside.update(range(first, first + len(window)))
                items.update(names)
    return sorted(inside), sorted(items)


def blocks(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, window: int, block: int):
    """Broadcast prefix indexes, one per block of at most about `block` (item, window) pairs; one empty index at least."""
    spark = docs.sparkSession
    ship(spark)
    pairs = _windows(benchmark, item, item_text, window).persist()
    n = max(1, -(-pairs.count() // block))
    for k in range(n):
        part = pairs.where(F.pmod(F.xxhash64("item", "gram"), F.lit(n)) == k)
        rows = [(r["item"], bytes(r["gram"])) for r in part.collect()]
        vocabulary = frozenset(w for _, g in rows for w in g.split(b" "))
        index = _prefix_index(rows, _rarity(docs, text, vocabulary)) if rows else {}
        yield spark.sparkContext.broadcast(index)
    pairs.unpersist()


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = 10, block: int = 100_000,
) -> DataFrame:
    """One row per document: (key, n_words LONG, hit ARRAY<INT> word positions, items ARRAY<STRING>)."""
    docs = docs.select(key, text)
    kind = docs.schema[key].dataType.simpleString()

    def scan(share, every):
        def run(batches):
            for batch in slices(batches, text):
                n, digest, hit, items = [], [], [], []
                found_in = []
                for row, t in enumerate(texts(batch, text)):
                    w = words_of(t)
                    inside, names = hits(w, share.value)
                    if every or inside:
                        found_in.append(row)
                        n.append(len(w))
                        digest.append(hashlib.blake2b(t, digest_size=16).digest())
                        hit.append(inside)
                        items.append(names)
                keys = batch.column(0).take(pa.array(found_in, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys, pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                        pa.array(hit, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
                    ],
                    [key, "n_words", "digest", "hit", "items"],
                )

        return run

    schema = f"`{key}` {kind}, n_words long, digest binary, hit array<int>, items array<string>"
    out = None
    for share in blocks(docs, benchmark, text, item, item_text, window, block):
        if out is None:
            out = docs.mapInArrow(scan(share, True), schema)
            continue
        # a later block only adds hits; rows of equal key and text have equal hits, so one of them answers for all
        more = docs.mapInArrow(scan(share, False), schema)
        more = more.groupBy(F.col(key).alias("_k"), F.col("digest").alias("_d")).agg(
            F.array_distinct(F.flatten(F.collect_set("hit"))).alias("_hit"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"),
        )
        out = out.join(more, F.col(key).eqNullSafe(F.col("_k")) & (F.col("digest") == F.col("_d")), "left").select(
            key,
            "n_words",
            "digest",
            F.array_sort(F.array_union("hit", F.coalesce("_hit", F.array().cast("array<int>")))).alias("hit"),
            F.array_sort(F.array_union("items", F.coalesce("_items", F.array().cast("array<string>")))).alias("items"),
        )
    return out.drop("digest")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = 10, block: int = 100_000,
) -> DataFrame:
    """The documents, all columns, in which no benchmark window occurs."""
    out = docs
    for share in blocks(docs, benchmark, text, item, item_text, window, block):

        def clean(batches, share=share):
            for batch in slices(batches, text):
                keep = [not hits(words_of(t), share.value)[0] for t in texts(batch, text)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(clean, docs.schema)
    return out
