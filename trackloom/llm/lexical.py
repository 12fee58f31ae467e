"""Ranked lexical search over an inverted index in shards: short lists summed first, long lists skipped.

Every document is indexed. A shard holds some megabytes of texts: its documents with their lengths, its lexicon and
the postings (document, occurrences) of each term; it is written once and no text is read again. Queries go over the
shards in blocks of bounded size. In each shard a query is answered in two ways at once:

* term at a time for its short lists: their scores are summed into accumulators, which then act as one more list with
  one bound;
* document at a time for its long lists beside that list: the shard is cut into windows of documents, a window whose
  bound (best accumulator plus the best of each long list there) is below the score of the worst document held is
  skipped; in the others long lists are merged only as long as the lists after them could still bring in a document
  by themselves, and looked up for the remaining candidates after that.

A task keeps the best documents of each query from shard to shard, so later shards are skipped more; it returns `top`
rows a query, and Spark ranks those of all tasks.

Scores: w = floor(1000 ln((2N+2)/(2df+1))) of a term; m = 75 + (25 n N) div L of a document; a document scores the sum
of w ((10^9 tf) div (1000 tf + 12 m)) over the query's terms, repeats included, in 64-bit integers.

Defined cases: a null or empty text has no terms and is in no result; a query without terms, or whose terms no
document holds, has no rows; repeated rows are documents (or queries) of their own; equal scores are ordered by key,
null keys last; very long texts make a shard of their own; an empty table gives no rows; extra columns are ignored.
Keys are integers; 25 n N must stay below 2^63.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import column_bytes, pack, ship, slices, texts, unpack
from trackloom.session import stage

SHARD_BYTES = 8 << 20
#: text of the queries that are sent to the tasks at once
QUERY_BYTES = 4 << 20
TOP = 20
#: a list is short if it names at most one document in so many
SHORT = 16
WINDOW = 512

_TERM = np.ones(256, bool)
_TERM[[b for b in range(128) if not chr(b).isalnum()]] = False


def terms_of(docs: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """(the terms of all texts in order, first term of each text and their number)."""
    joined = b"\n".join([*docs, b""]).lower()
    flat = np.frombuffer(joined, np.uint8)
    inside = _TERM[flat]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat[inside])])
    edges = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    return terms, np.searchsorted(starts, edges)


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(n_docs, n_terms LONG, docs, lexicon, postings BINARY): a row per shard, each column an Arrow table.

    docs (key, n): the documents with terms; lexicon (term, df) in the order of its lists; postings (doc, tf), where
    doc is the place in docs, in ascending order within a list.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in slices(batches, text, shard_bytes):
            terms, edges = terms_of(texts(batch, text))
            n = np.diff(edges)
            with_terms = np.flatnonzero(n)
            if not len(with_terms):
                continue
            coded = terms.dictionary_encode()
            n = n[with_terms]
            posting = coded.indices.to_numpy().astype(np.int64) * len(n) + np.repeat(np.arange(len(n)), n)
            posting.sort()
            first = np.flatnonzero(np.concatenate([[True], posting[1:] != posting[:-1]]))
            tf = np.diff(np.append(first, len(posting)))
            term, doc = np.divmod(posting[first], len(n))
            keys = batch.column(batch.schema.get_field_index(key)).take(pa.array(with_terms)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(n)], pa.int64()), pa.array([len(terms)], pa.int64()), pa.array([pack(key=keys, n=n)]),
                    pa.array([pack(term=coded.dictionary, df=np.bincount(term).astype(np.int32))]),
                    pa.array([pack(doc=doc.astype(np.int32), tf=tf.astype(np.int32))]),
                ],
                ["n_docs", "n_terms", "docs", "lexicon", "postings"],
            )

    fields = "n_docs long, n_terms long, docs binary, lexicon binary, postings binary"
    return stage(docs.select(key, text).mapInArrow(run, fields), "index")


class Best:
    """The best documents of one query so far."""

    def __init__(self, top: int):
        self.top = top
        self.score = self.key = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.least = 1  # a document below this score is not wanted

    def add(self, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        self.score, self.key, self.null = (np.concatenate(p) for p in ((self.score, score), (self.key, key), (self.null, null)))
        if len(self.score) > self.top:
            floor = np.partition(self.score, -self.top)[-self.top]
            near = np.flatnonzero(self.score >= floor)
            chosen = near[np.lexsort((self.key[near], self.null[near], -self.score[near]))[: self.top]]
            self.score, self.key, self.null = self.score[chosen], self.key[chosen], self.null[chosen]
        if len(self.score) == self.top:
            self.least = int(self.score.min())


class Shard:
    """The lists of one shard that some query of the block asks for, with impacts and their bounds by window."""

    def __init__(self, docs: bytes, lexicon: bytes, postings: bytes, vocabulary: pa.Array, n_docs: int, n_terms: int):
        docs, lexicon, postings = unpack(docs), unpack(lexicon), unpack(postings)
        n = docs["n"].to_numpy()
        self.null = docs["key"].is_null().to_numpy(zero_copy_only=False)
        self.key = pc.fill_null(docs["key"], 0).to_numpy()
        self.size = len(n)
        m = 75 + 25 * n * n_docs // n_terms
        at = pc.index_in(vocabulary, value_set=lexicon["term"])
        self.asked = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        at = at.drop_null().to_numpy()
        df = lexicon["df"].to_numpy().astype(np.int64)
        first, self.df = (np.cumsum(df) - df)[at], df[at]
        self.end = np.cumsum(self.df)
        self.start = self.end - self.df
        here = np.repeat(first - self.start, self.df) + np.arange(int(self.df.sum()))
        self.doc = postings["doc"].to_numpy()[here]
        tf = postings["tf"].to_numpy()[here].astype(np.int64)
        self.impact = 10**9 * tf // (1000 * tf + 12 * m[self.doc])
        self.windows = -(-self.size // WINDOW)
        self.best = np.zeros((len(at), self.windows), np.int64)
        if len(here):
            cell = np.repeat(np.arange(len(at)), self.df) * self.windows + self.doc // WINDOW
            lead = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            self.best.reshape(-1)[cell[lead]] = np.maximum.reduceat(self.impact, lead)
        #: vocabulary place -> list, -1 for none
        self.list_of = np.full(len(vocabulary), -1)
        self.list_of[self.asked] = np.arange(len(at))

    def answer(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer this shard's documents to the best of a query (places in the vocabulary, weight x repeats)."""
        lists = self.list_of[terms]
        here = (lists >= 0) & (weights > 0)
        lists, weights = lists[here], weights[here]
        if not len(lists):
            return
        short = self.df[lists] * SHORT <= self.size
        sums = np.zeros(self.windows * WINDOW, np.int64)
        for k, w in zip(lists[short].tolist(), weights[short].tolist()):
            a, b = self.start[k], self.end[k]
            sums[self.doc[a:b]] += w * self.impact[a:b]
        long, weights = lists[~short], weights[~short]
        bounds = self.best[long] * weights[:, None]
        top = bounds.sum(axis=0) + sums.reshape(-1, WINDOW).max(axis=1)
        for window in np.argsort(-top, kind="stable").tolist():
            if top[window] < best.least:
                break
            self._window(window, long, weights, bounds[:, window], sums, best)

    def _window(self, window: int, long: np.ndarray, weights: np.ndarray, bounds: np.ndarray, sums: np.ndarray, best: Best) -> None:
        lo = window * WINDOW
        score = sums[lo : lo + WINDOW].copy()
        order = np.argsort(-bounds, kind="stable")
        left = int(bounds.sum())
        candidates = None
        for i in order.tolist():
            if not bounds[i]:
                break
            if candidates is None and left < best.least:  # what is left brings in no document by itself
                candidates = np.flatnonzero(score + left >= best.least)
            k, w = long[i], int(weights[i])
            a, b = self.start[k] + np.searchsorted(self.doc[self.start[k] : self.end[k]], [lo, lo + WINDOW])
            at, gain = self.doc[a:b] - lo, w * self.impact[a:b]
            left -= int(bounds[i])
            if candidates is None:
                score[at] += gain
            else:
                spot = np.minimum(np.searchsorted(at, candidates), len(at) - 1)
                score[candidates] += np.where(at[spot] == candidates, gain[spot], 0)
                candidates = candidates[score[candidates] + left >= best.least]
                if not len(candidates):
                    return
        if candidates is None:
            candidates = np.arange(WINDOW)
        found = candidates[score[candidates] >= best.least]
        if len(found):
            best.add(score[found], self.key[lo + found], self.null[lo + found])


def _block(rows: list, shards: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame | None:
    """(query INT, key, score): the best of every task for the queries of `rows` (item, text)."""
    terms, edges = terms_of([t or b"" for _, t in rows])
    coded = terms.dictionary_encode()
    vocabulary, of = coded.dictionary, coded.indices.to_numpy()
    if not len(vocabulary):
        return None
    spark = shards.sparkSession
    words = spark.sparkContext.broadcast(vocabulary)

    def holders(batches):
        for batch in batches:
            for data in column_bytes(batch, "lexicon"):
                lexicon = unpack(data.as_py())
                at = pc.index_in(words.value, value_set=lexicon["term"])
                here = pa.array(np.flatnonzero(at.is_valid()), pa.int32())
                yield pa.RecordBatch.from_arrays([here, lexicon["df"].take(at.drop_null()).cast(pa.int64())], ["term", "df"])

    df = np.zeros(len(vocabulary), np.int64)
    for r in shards.select("lexicon").mapInArrow(holders, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    queries = []
    for a, b in zip(edges, edges[1:]):
        term, times = np.unique(of[a:b], return_counts=True)
        queries.append((term, times * weight[term]))
    share = spark.sparkContext.broadcast(queries)

    def rank(batches):
        best = [Best(top) for _ in share.value]
        for batch in batches:
            columns = [column_bytes(batch, n) for n in ("docs", "lexicon", "postings")]
            for i in range(batch.num_rows):
                shard = Shard(*(c[i].as_py() for c in columns), words.value, n_docs, n_terms)
                for (term, w), held in zip(share.value, best):
                    shard.answer(term, w, held)
        for q, held in enumerate(best):
            if len(held.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(held.score), pa.int32()), pa.array(held.key, mask=held.null), pa.array(held.score)],
                    ["query", "key", "score"],
                )

    return shards.select("docs", "lexicon", "postings").mapInArrow(rank, "query int, key long, score long")


def search(
    docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    top: int = TOP, query_bytes: int = QUERY_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(item, rank INT, key LONG, score LONG): the `top` best documents of every query with a score above 0."""
    spark = docs.sparkSession
    shards = index(docs, key, text, shard_bytes)
    total = shards.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    size = queries.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = -(-size // query_bytes)
    kind = queries.schema[item].dataType.simpleString()
    best = spark.createDataFrame([], f"block int, query int, item {kind}, key long, score long")
    for b in range(blocks if total.n_docs else 0):
        mine = queries.select(F.col(item).alias("item"), F.col(item_text).cast("binary").alias("t"))
        if blocks > 1:
            mine = mine.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == b)
        rows = [(r.item, None if r.t is None else bytes(r.t)) for r in mine.collect()]  # about query_bytes of text
        found = _block(rows, shards, total.n_docs, total.n_terms, top)
        if found is not None:
            names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], f"query int, item {kind}")
            best = best.unionByName(found.join(names, "query").withColumn("block", F.lit(b)))
    place = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
