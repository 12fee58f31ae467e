"""Substring dedup by paragraph MinHash banding, with exact Jaccard verification and clusters of removals.

Texts are told apart by a 128-bit digest; a text that an earlier row holds under another key is a copy and goes whole.
Of the distinct texts two kinds of paragraphs are matched, A-Z lower-cased:

* lines of at least `line_words` words, on shingles of five words. A line's MinHash signature is its smallest shingle
  hashes, a fifth of them and one more, each a band of its own: two lines at a Jaccard similarity of 0.8 always share
  one. Equal lines are one. Lines of a band are joined with each other, as far as size and rank of the shared hash allow
  the similarity, and verified by exact Jaccard similarity of their shingle sets. Bands of more than `FEW` lines are joined
  with their earliest line instead; those unlike it are joined with all others of such bands that share one of their
  rarest shingles, as any pair at that similarity must, and verified too. Two lines like the earliest both go and are one
  component through it.
* stretches of `PASSAGE` words, for passages copied into the middle of other lines, which no line similarity shows.
  Each stretch is banded by its MinHash shingle, the anchor (a band of one row that overlapping stretches share), and
  the runs of `UNIT` words that end and start with the anchor are the paragraphs. Two texts that share `PASSAGE` words
  share an anchor, and with it at least one of the two runs, so every repeat of that length is found. These runs must
  be equal by a 128-bit digest of their words. Around them the words themselves are compared with those of all earlier
  places of the run, in order or, where it has very many, by halving the number of words, so that a repeated passage
  goes from its first word to its last.

Of each match the first occurrence in (key, position) order stays and the others are removed, but for words that
belong to the first occurrence of what a text repeats of itself. Documents that share a paragraph form components.

Defined cases: null and short texts have no paragraphs and are kept; a paragraph repeated inside one document loses
its later copies; lines under `line_words` words are only removed as parts of passages or copies; of rows that repeat a
key and text none counts as a copy of the other; of rows that repeat a key with unlike texts each is a document of its
own, but they are one in components; a row with a null key neither loses nor gives a paragraph; very long texts are
handled like others, one at a time; extra columns, whatever their names, are kept by `remove_repeats` and ignored by
`find_repeats`; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import ASCII_WHITE, fresh, mix, ship, slices, span_hashes, split_by_ids, strings, texts
from trackloom.operators.graph import components
from trackloom.session import discard, stage

SHINGLE = 5
SIMILAR = 0.8
#: lines of a band of which every two are compared; fuller bands go through their earliest line
FEW = 64
#: lines of fewer words are no paragraphs: ordinary short lines are common to texts that have nothing else in common
LINE_WORDS = 20
PASSAGE = 50
UNIT = (PASSAGE + SHINGLE - 1) // 2
REACH = PASSAGE - UNIT  # a repeated stretch of PASSAGE words ends at most so many words from a run that repeats
#: places of a run that a task goes through in order; runs of more go by rounds
MANY = 256
LINE, RUN, TEXT, LOST, KEPT = range(5)
GONE, OTHER, STAY = range(3)
_ROW = "doc binary, kind int, start int, words int, same binary, bands array<long>, hashes int"


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of the five words from each position (those that run past the end are meaningless)."""
    out = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        out[: len(words) - k] += words[k:] * np.uint64(2 * k + 3)
    return mix(out)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best over values[i : i + width] for every i that has so many, by blocks of `width` scanned both ways."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    padded = np.full(size, values[-1], values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    up = best.accumulate(grid, axis=1).reshape(-1)
    down = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(down[:n], up[width - 1 : width - 1 + n])


def anchors(sh: np.ndarray, edges: np.ndarray, window: int) -> np.ndarray:
    """Positions whose shingle is the smallest of some `window` consecutive ones inside one document."""
    if len(sh) < window:
        return np.zeros(0, np.int64)
    ends = np.repeat(edges[1:], np.diff(edges)) - (SHINGLE - 1)  # end of the shingles of each position's document
    low = _sliding(sh, window, np.minimum)
    at = np.arange(len(low))
    low[at + window > ends[: len(low)]] = 0  # not inside one document
    reach = np.concatenate([np.zeros(window - 1, np.uint64), low, np.zeros(window - 1, np.uint64)])
    top = _sliding(reach, window, np.maximum)[: len(sh)]
    return np.flatnonzero((sh <= top) & (np.arange(len(sh)) < ends))


class Words:
    """The words of some texts, A-Z lower-cased: where they lie, and a 64-bit hash of each.

    The hashes only choose bands and anchors; what is equal is decided by 128-bit digests of the words themselves.
    """

    def __init__(self, docs: list[bytes]):
        flat = np.frombuffer(b"\n".join([*docs, b""]).lower(), np.uint8)
        white = ASCII_WHITE[flat]
        before = np.empty_like(white)
        before[:1], before[1:] = True, white[:-1]
        starts, after = np.flatnonzero(before & ~white), white & ~before
        ends = np.flatnonzero(after)
        self.hash = mix(span_hashes(flat.astype(np.uint64) + np.uint64(1), starts, ends))
        spaced = flat[~white | after]
        spaced[np.cumsum(ends - starts + 1) - 1] = 32
        self.spaced = spaced.tobytes()  # every word and a space
        self.at = np.concatenate([[0], np.cumsum(ends - starts + 1)])  # where each word begins in it
        self.edges = np.searchsorted(starts, np.cumsum([0, *(len(d) + 1 for d in docs)]))
        self.lines = np.searchsorted(starts, np.concatenate([[0], np.flatnonzero(flat == 10) + 1]))

    def text(self, first: int, end: int) -> bytes:
        """The words [first, end), a space between."""
        return self.spaced[self.at[first] : self.at[end] - 1] if first < end else b""

    def texts(self, first: np.ndarray, end: np.ndarray) -> list[bytes]:
        """As `text` for many stretches, none of them empty."""
        s = self.spaced
        return [s[a:b] for a, b in zip(self.at[first].tolist(), (self.at[end] - 1).tolist())]

    def digests(self, first: np.ndarray, end: np.ndarray) -> list[bytes]:
        return list(map(xxhash.xxh3_128_digest, self.texts(first, end)))


def lines_of(w: Words, line_words: int = LINE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, bands of all lines in one array, where each line's bands begin, distinct hashes) of every long line.

    The bands are a line's smallest shingle hashes, ascending. At most n - ceil(0.8 n) of a line's n shingles are missing
    from a similar one, so the smallest hash that both have is among one more than that in both, also where hashes of
    unlike shingles are equal; n counts shingles with repeats, which can only lengthen the list.
    """
    first, last = w.lines[:-1], w.lines[1:]
    long = last - first >= max(line_words, SHINGLE)
    first, last = first[long], last[long]
    n = last - first - SHINGLE + 1
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    sh = shingles(w.hash)[at + np.repeat(first, n)]
    order = np.lexsort((sh, of))
    sh, of = sh[order], of[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (of[1:] != of[:-1])
    sh, of = sh[new], of[new]
    hashes = np.bincount(of, minlength=len(n))
    rank = np.arange(len(of)) - np.repeat(np.cumsum(hashes) - hashes, hashes)
    most = n - np.ceil(n * SIMILAR - 1e-9).astype(np.int64) + 1
    held = np.minimum(hashes, most)
    return first, last, sh[rank < most[of]], np.cumsum(np.append(0, held)), hashes


def runs_of(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word) of the runs that end and start with an anchor."""
    at = anchors(shingles(w.hash), w.edges, PASSAGE - SHINGLE + 1)
    starts = np.unique(np.concatenate([at - (UNIT - SHINGLE), at]))
    of = np.searchsorted(w.edges, starts, "right") - 1
    inside = (starts >= 0) & (starts + UNIT <= w.edges[np.minimum(of + 1, len(w.edges) - 1)])
    return of[inside], starts[inside]


def repeated_inside(w: Words, doc: np.ndarray, start: np.ndarray, same: list[bytes]) -> np.ndarray:
    """For each run the place of an earlier one of its text with the same run and the same REACH words around, or -1.

    Only runs that a text repeats are looked at; what is compared are the words.
    """
    out = np.full(len(start), -1)
    first: dict[tuple[int, bytes], int] = {}
    again = {}
    for i, k in enumerate(zip(doc.tolist(), same)):
        if first.setdefault(k, i) != i:
            again.setdefault(k, [first[k]]).append(i)
    seen: dict[tuple[int, bytes], int] = {}
    for (d, _), places in again.items():
        lo, hi = int(w.edges[d]), int(w.edges[d + 1])
        for i in places:
            a, b = max(lo, int(start[i]) - REACH), min(hi, int(start[i]) + UNIT + REACH)
            near = bytes([int(start[i]) - a]) + w.text(a, b)
            j = seen.setdefault((d, near), i)
            if j != i:
                out[i] = start[j]
    return out


def _joined(first: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, end) of what the stretches cover, overlapping ones of a document as one."""
    order = np.argsort(first, kind="stable")
    doc, first, end = doc[order], first[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] > end[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], first[at], end[np.append(at[1:], len(first)) - 1] if len(at) else end[:0]


def paragraphs(docs: DataFrame, line_words: int = LINE_WORDS) -> DataFrame:
    """The paragraphs of every row of (doc, text).

    LINE and RUN: start, words and digest. TEXT: a whole text of `line_words` words or more. LOST and KEPT: stretches around
    runs that repeat earlier ones of their own text with the same words around, and the stretches that these repeat.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            w = Words(texts(batch, "text"))
            size = np.diff(w.edges)
            first, last, bands, cut, hashes = lines_of(w, line_words)
            doc, start = runs_of(w)
            same = w.digests(start, start + UNIT)
            to = repeated_inside(w, doc, start, same)
            new, own = np.flatnonzero(to < 0), np.flatnonzero(to >= 0)
            whole = np.flatnonzero(size >= max(line_words, 1))
            # the words around are the same, so the stretch begins as far before both places
            lead = np.minimum(start[own] - w.edges[doc[own]], REACH)
            tail = np.minimum(w.edges[doc[own] + 1] - start[own] - UNIT, REACH)
            lost, kept = (_joined(at - lead, at + UNIT + tail, doc[own]) for at in (start[own], to[own]))
            line_doc = np.searchsorted(w.edges, first, "right") - 1
            parts = [
                (LINE, line_doc, first, last - first, w.digests(first, last)),
                (RUN, doc[new], start[new], np.full(len(new), UNIT), [same[i] for i in new.tolist()]),
                (TEXT, whole, w.edges[whole], size[whole], [None] * len(whole)),
                *((kind, d, at, end - at, [None] * len(d)) for kind, (d, at, end) in ((LOST, lost), (KEPT, kept))),
            ]
            for kind, d, at, n, digest in parts:
                rows = len(d)
                lists, sizes = pa.nulls(rows, pa.list_(pa.int64())), pa.nulls(rows, pa.int32())
                if kind == LINE:
                    lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(bands.view(np.int64)))
                    sizes = pa.array(hashes, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(d)), pa.array(np.full(rows, kind, np.int32)), pa.array((at - w.edges[d]).astype(np.int32)),
                        pa.array(n.astype(np.int32)), pa.array(digest, pa.binary()), lists, sizes,
                    ],
                    ["doc", "kind", "start", "words", "same", "bands", "hashes"],
                )

    return docs.select("doc", "text").mapInArrow(run, _ROW)


def listed(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(row of each item, the items) of a column of lists."""
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten()


def _among(rows: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """The rows whose `column` is among the values; a filter of fixed size spares most others the shuffle."""
    may, _ = split_by_ids(rows, column, values.select(column))
    return may.join(values.select(column), column, "left_semi")


def _repeated(rows: DataFrame) -> DataFrame:
    """The distinct rows (kind, doc, start, words, same) whose `same` stands at two places or more."""
    hashed = rows.select("kind", "doc", "start", "words", "same", F.xxhash64("kind", "same").alias("h"))
    place = F.xxhash64("doc", "start")
    twice = hashed.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("h")
    # equal hashes of unlike paragraphs only cost a row: what follows groups by `same`
    return _among(hashed, "h", stage(twice, "twice")).drop("h").distinct()


_PLACE = ["key", "doc", "start"]


def _place(prefix: str = "") -> Column:
    return F.struct(*(F.col(f"{prefix}{c}").alias(c) for c in _PLACE))


def _to(struct: str) -> list[Column]:
    return [F.col(f"{struct}.{c}").alias(f"to_{c}") for c in _PLACE]


def _again(places: DataFrame, by: list[str]) -> DataFrame:
    """Every place that is not the first of its group, with the first, to_key, to_doc, to_start, and a hash of the texts
    that hold the group."""
    holders = F.sum(F.xxhash64("doc").cast("decimal(20,0)"))
    firsts = stage(places.groupBy(*by).agg(F.min(_place()).alias("first"), F.xxhash64(F.count("*"), holders).alias("holders")), "firsts")
    met = places.join(firsts, by).where(_place() != F.col("first"))
    return met.select(*places.columns, *_to("first"), "holders")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`docs` (key, doc, text) joined with the wanted rows (key, doc, ...): one row per text, copies are not asked for."""
    wanted = stage(wanted.withColumn("identity", F.struct("key", "doc")), "wanted")
    own = docs.withColumn("identity", F.struct("key", "doc")).select("identity", "text")
    asked, _ = split_by_ids(own, "identity", wanted.select("identity"))
    return asked.join(wanted.drop("key", "doc"), "identity").select("identity.doc", *(c for c in wanted.columns if c not in ("identity", "key", "doc")), "text")


def line_sets(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(same, set ARRAY<LONG>): hashes of the distinct shingles of the lines (key, doc, start, words, same)."""
    per = lines.groupBy("key", "doc").agg(F.collect_set(F.struct("start", "words", "same")).alias("lines"))

    def run(batches):
        for batch in slices(batches, "text"):
            w = Words(texts(batch, "text"))
            same, sets = [], []
            for i, lines in enumerate(batch.column(1).to_pylist()):
                for ln in lines:
                    at = np.arange(ln["words"] - SHINGLE + 1) + int(w.edges[i]) + ln["start"]
                    same.append(ln["same"])
                    sets.append(np.unique(np.array(list(map(xxhash.xxh3_64_intdigest, w.texts(at, at + SHINGLE))), np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(same, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["same", "set"])

    return _texts_of(docs, per).mapInArrow(run, "same binary, set array<long>").dropDuplicates(["same"])


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (same, other) whose shingle sets have a Jaccard similarity of SIMILAR."""
    # Jaccard similarity by the intersection alone, which is so worked out once for a pair
    fits = F.expr(f"size(array_intersect(set, other_set)) >= {SIMILAR / (1 + SIMILAR)} * (size(set) + size(other_set)) - 1e-9")
    met = pairs.join(sets, "same").join(sets.select(F.col("same").alias("other"), F.col("set").alias("other_set")), "other")
    return met.where(fits).select("same", "other")


def _rarest_shared(lines: DataFrame, sets: DataFrame) -> DataFrame:
    """(same, other): pairs of the lines (same, open), one of them open, that share one of their rarest shingles.

    Of two sets at the similarity the smaller has, in one order of all shingles, one of its first n - ceil(8n/9) + 1 among
    the first m - ceil(4m/5) + 1 of the larger; the places in that order bound what they can share.
    """
    each = stage(lines.join(sets, "same").select("same", "open", F.size("set").alias("n"), F.explode("set").alias("shingle")), "rare")
    count = each.groupBy("shingle").agg(F.count("*").alias("times"))
    order = Window.partitionBy("same").orderBy("times", "shingle")  # as many rows as the line has words
    most = lambda share: F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    # a shingle of one line alone is in no pair, but keeps its place in the order
    placed = each.join(count, "shingle").withColumn("at", F.row_number().over(order)).where("times > 1")
    large = stage(placed.where(F.col("at") <= most(SIMILAR)).drop("times"), "rare")
    small = large.where(F.col("at") <= most(2 * SIMILAR / (1 + SIMILAR)))
    x = small.select("shingle", F.col("same").alias("x"), F.col("open").alias("x_open"), F.col("n").alias("x_n"), F.col("at").alias("x_at"))
    y = large.select("shingle", F.col("same").alias("y"), F.col("open").alias("y_open"), F.col("n").alias("y_n"), F.col("at").alias("y_at"))
    fits = "x <> y and (x_open or y_open) and x_n <= y_n and x_n >= {t} * y_n - 1e-9 and 1 + least(x_n - x_at, y_n - y_at) >= {t} / (1 + {t}) * (x_n + y_n) - 1e-9"
    met = x.join(y, "shingle").where(fits.format(t=SIMILAR))
    met = stage(met.select(F.greatest("x", "y").alias("same"), F.least("x", "y").alias("other")).distinct(), "rare")
    for done in (each, large):
        discard(done)
    return met


def _paired(rows: DataFrame) -> DataFrame:
    """(same, other): the lines of one band (h, same, words, hashes, at) that may be similar.

    At the smallest hash that two lines share, `at` of their own lie before it in each, so the shingles they share are among
    the others; a line has at least as many distinct shingles as hashes, and at most as many as places for one.
    """
    side = lambda p: rows.select("h", F.col("same").alias(p), *(F.col(c).alias(f"{p}_{c}") for c in ("hashes", "at")), (F.col("words") - SHINGLE + 1).alias(f"{p}_n"))
    fits = "x > y and x_n >= {t} * y_hashes - 1e-9 and y_n >= {t} * x_hashes - 1e-9 and least(x_n - x_at, y_n - y_at) >= {t} / (1 + {t}) * (x_hashes + y_hashes) - 1e-9"
    return side("x").join(side("y"), "h").where(fits.format(t=SIMILAR)).select(F.col("x").alias("same"), F.col("y").alias("other")).distinct()


def similar_lines(docs: DataFrame, lines: DataFrame, contents: DataFrame) -> DataFrame:
    """(key, doc, start, words, to_key, to_doc, to_start): the first place of a line, and that of a similar earlier line.

    `lines`: (doc, start, words, same, bands, hashes). Every line that has a similar earlier one is there with one at least,
    and all similar lines are joined, directly or through others.
    """
    each = lines.select("words", "same", "hashes", F.posexplode("bands").alias("at", "h"))
    line = F.xxhash64("same")
    twice = each.groupBy("h").agg(F.min(line).alias("lo"), F.max(line).alias("hi")).where("lo <> hi").select("h")
    banded = stage(_among(each, "h", stage(twice, "bands")).distinct(), "bands")
    members = stage(banded.join(banded.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "h"), "bands")
    discard(banded)
    near = stage(_paired(members.where(F.col("n") <= FEW)), "pairs")
    many = members.where(F.col("n") > FEW).select("h", "same")
    own = stage(near.select("same").union(near.select("other")).union(many.select("same")).distinct(), "lines")
    places = stage(_among(lines.select("doc", "start", "words", "same"), "same", own).distinct().join(contents, "doc"), "lines")
    firsts = stage(places.groupBy("same").agg(F.min(F.struct(*_PLACE, "words")).alias("f")).select("same", "f.*"), "lines")
    sets = stage(line_sets(docs, firsts), "sets")
    heads = stage(many.join(firsts, "same").groupBy("h").agg(F.min_by("same", _place()).alias("head")), "bands")
    met = many.join(heads, "h").select("h", "same", "head", F.greatest("same", "head").alias("a"), F.least("same", "head").alias("b"))
    met = stage(met, "bands")
    with_head = met.where("same <> head").select("a", "b")
    like = stage(_alike(near.union(with_head).distinct(), sets), "pairs")
    taken = like.select(F.col("same").alias("a"), F.col("other").alias("b"), F.lit(True).alias("taken"))
    opened = met.join(taken, ["a", "b"], "left").select("h", "same", (F.col("taken").isNull() & (F.col("same") != F.col("head"))).alias("open"))
    opened = stage(opened, "bands")
    bands = opened.groupBy("h").agg(F.max("open").alias("any")).where("any").select("h")
    among = opened.join(bands, "h").groupBy("same").agg(F.max("open").alias("open"))
    more = _alike(_rarest_shared(among, sets), sets)
    pairs = stage(like.union(more).distinct(), "pairs")
    two = pairs.join(firsts, "same").join(
        firsts.select(F.col("same").alias("other"), *(F.col(c).alias(f"o_{c}") for c in (*_PLACE, "words"))), "other"
    )
    later = _place() > _place("o_")
    pick = lambda c, mine: F.when(later == F.lit(mine), F.col(c)).otherwise(F.col(f"o_{c}"))
    out = two.select(
        *(pick(c, True).alias(c) for c in (*_PLACE, "words")), *(pick(c, False).alias(f"to_{c}") for c in _PLACE)
    )
    out = stage(out, "matches")
    for done in (members, near, own, places, firsts, sets, heads, met, like, opened, pairs):
        discard(done)
    return out


def _edge_runs(found: DataFrame) -> DataFrame:
    """(same, side): the runs near an end, 0 left or 1 right, of what the repeated runs of a text cover.

    A passage that goes on beyond the end holds the outermost run; of the others only those that other texts hold count.
    """
    per = found.groupBy("doc").agg(F.collect_set(F.struct("start", "same", "holders")).alias("runs"))

    def run(batches):
        for batch in batches:
            of, values = listed(batch.column(0))
            start, holders = (values.field(c).to_numpy() for c in ("start", "holders"))
            order = np.lexsort((start, of))
            begins_, holders_ = start[order].tolist(), holders[order].tolist()
            cuts_ = np.searchsorted(of, np.arange(batch.num_rows + 1)).tolist()
            at, side = [], []
            for x, y in zip(cuts_, cuts_[1:]):
                begins = begins_[x:y]
                for lo, hi in merged([(b, b + UNIT) for b in begins]):
                    left = range(bisect_left(begins, lo), bisect_left(begins, lo + REACH))
                    right = range(bisect_right(begins, hi - UNIT - REACH), bisect_left(begins, hi))[::-1]
                    for k, near in enumerate((left, right)):
                        seen = set()
                        for r in near:
                            if holders_[x + r] not in seen:
                                seen.add(holders_[x + r])
                                at.append(x + r)
                                side.append(k)
            same = values.field("same").take(pa.array(order[np.array(at, np.int64)]))
            yield pa.RecordBatch.from_arrays([same, pa.array(side, pa.int32())], ["same", "side"])

    return per.select("runs").mapInArrow(run, "same binary, side int").distinct()


def _contexts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(key, doc, start, side, same, near STRING, room INT): the REACH words before (side 0, last one first) or after a run.

    A place is there as often as its row (key, doc) is in `docs`.
    """
    per = places.groupBy("key", "doc").agg(F.collect_set(F.struct("key", "start", "side", "same")).alias("runs"))
    kind = places.schema["key"].dataType

    def run(batches):
        for batch in slices(batches, "text"):
            w = Words(texts(batch, "text"))
            of, values = listed(batch.column(1))
            start, side = (values.field(c).to_numpy() for c in ("start", "side"))
            at = w.edges[of] + start
            first = np.where(side == 1, at + UNIT, np.maximum(w.edges[of], at - REACH))
            end = np.maximum(first, np.where(side == 1, np.minimum(w.edges[of + 1], at + UNIT + REACH), at))
            near = [w.text(a, b) for a, b in zip(first.tolist(), end.tolist())]
            near = [(t if after else b" ".join(t.split(b" ")[::-1])).decode("utf-8", "replace") for t, after in zip(near, side.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    values.field("key"), batch.column(0).take(pa.array(of)), values.field("start"), values.field("side"),
                    values.field("same"), pa.array(near, pa.string()), pa.array((end - first).astype(np.int32)),
                ],
                ["key", "doc", "start", "side", "same", "near", "room"],
            )

    fields = f"key {kind.simpleString()}, doc binary, start int, side int, same binary, near string, room int"
    return _texts_of(docs, per).mapInArrow(run, fields)


def _ends_by_order(near: DataFrame) -> DataFrame:
    """(key, doc, start, side, d, to_key, to_doc, to_start): for each place the most words around it, `d`, that an earlier
    place of the same run has too, and the first place with these words; places that share no word are left out.

    The places of a run come to one task in order; a table of the words so far, from the run on, tells what is shared.
    """
    kind = near.schema["key"].dataType.simpleString()

    def run(batches):
        run_, last, whole, begun = None, None, {}, {}
        for batch in batches:
            own, words, to = [], [], []
            columns = (batch.column(i).to_pylist() for i in range(6))
            for i, (key, doc, start, side, same, text) in enumerate(zip(*columns)):
                if (same, side) != run_:
                    run_, last, whole, begun = (same, side), None, {}, {}
                place = (key, doc, start)
                if place == last or not text:
                    continue
                last = place
                d, first = 0, whole.setdefault(text, place)
                if first is not place:  # all the same words
                    d = text.count(" ") + 1
                else:
                    first, end = None, text.find(" ")
                    while (met := begun.setdefault(text[:end] if end >= 0 else text, place)) is not place:
                        d, first = d + 1, met
                        if end < 0:
                            break
                        end = text.find(" ", end + 1)
                    while end >= 0:
                        end = text.find(" ", end + 1)
                        begun[text[:end] if end >= 0 else text] = place
                if d:
                    own.append(i)
                    words.append(d)
                    to.append(first)
            mine = batch.take(pa.array(own, pa.int64()))
            to_ = [pa.array([t[k] for t in to], batch.schema.field(k).type) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*mine.columns[:4], pa.array(words, pa.int32()), *to_], [*_PLACE, "side", "d", *(f"to_{c}" for c in _PLACE)]
            )

    ordered = near.repartition("same", "side").sortWithinPartitions("same", "side", *_PLACE).select(*_PLACE, "side", "same", "near")
    return ordered.mapInArrow(run, f"key {kind}, doc binary, start int, side int, d int, to_key {kind}, to_doc binary, to_start int")


def ends(docs: DataFrame, runs: DataFrame, found: DataFrame) -> DataFrame:
    """(key, doc, start, words, to_key, to_doc, to_start): the words around repeated runs up to where the repeat ends.

    `runs`: all places of repeated runs; `found`: those that have an earlier one. For each place the most words around it
    that an earlier place of the run has too are found by going through the run's places in order, one task a run. Runs of
    more than `MANY` places go by rounds instead, so that none is gathered; the result is the same.
    """
    edge = stage(_edge_runs(found), "edges")
    places = runs.join(edge, "same").select(*_PLACE, "side", "same")
    run = ["same", "side"]
    near = stage(_contexts(docs, places), "near")
    full = stage(near.groupBy(*run).agg(F.count("*").alias("n")).where(F.col("n") > MANY).select(*run), "near")
    got = _ends_by_order(near.join(full, run, "left_anti"))
    if not full.isEmpty():
        got = got.unionByName(_ends_by_rounds(near.join(full, run, "left_semi").distinct()))
    shift = F.when(F.col("side") == 1, F.lit(UNIT)).otherwise(-F.col("d"))
    return got.select(
        "key", "doc", (F.col("start") + shift).alias("start"), F.col("d").alias("words"), "to_key", "to_doc", (F.col("to_start") + shift).alias("to_start")
    )


def _ends_by_rounds(near: DataFrame) -> DataFrame:
    """As `_ends_by_order`, for distinct places: the number of shared words is searched by halving.

    A place that is the first with its next words stays behind with the other firsts, and any later place it may share
    fewer words with is among these; the rest, and the first beside them as a witness, go on to more words. Each round is
    one grouping of about a row per place.
    """
    whole = ["same", "side", "near", "room"]
    near = stage(near, "near")
    # places with all the same words around are settled at once; only the first of them goes on
    firsts = stage(near.groupBy(*whole).agg(F.min(_place()).alias("first"), F.count("*").alias("n")), "near")
    equal = near.join(firsts.where("n > 1"), whole).where((_place() != F.col("first")) & (F.col("room") > 0))
    equal = stage(equal.select(*_PLACE, "side", F.col("room").alias("d"), *_to("first")), "ends")
    nothing = [F.lit(None).cast(near.schema[c].dataType).alias(f"to_{c}") for c in _PLACE]
    state = stage(firsts.select("first.*", "same", "side", "near", "room", F.lit(0).alias("d"), *nothing), "ends")
    discard(near)
    discard(firsts)
    step = 1 << (REACH.bit_length() - 1)
    while step:
        probe = state.withColumn("next", F.when(F.col("room") >= F.col("d") + step, F.expr(f"substring_index(near, ' ', d + {step})")))
        by = ["same", "side", "d", "next"]
        firsts = stage(probe.where("next is not null").groupBy(*by).agg(F.min(_place()).alias("first"), F.count("*").alias("n")), "ends")
        met = probe.join(firsts.where("n > 1"), by, "left")
        is_first = F.col("first") == _place()
        stays = met.where(F.col("first").isNull() | is_first).select(*state.columns)
        more = F.when(is_first, F.lit(None))
        goes = met.where("first is not null").select(
            *(c for c in state.columns if c != "d" and not c.startswith("to_")), (F.col("d") + step).alias("d"),
            *(more.otherwise(F.col(f"first.{c}")).alias(f"to_{c}") for c in _PLACE),
        )
        after = stage(stays.unionByName(goes), "ends")
        discard(state)
        discard(firsts)
        state, step = after, step // 2
    return state.where("to_doc is not null").select(*equal.columns).unionByName(equal)


def digest(text: Column) -> Column:
    """The first 16 bytes of the text's SHA-256; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def own_columns(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), digest(F.col(text)).alias("doc"), F.col(text).alias("text"))


_MATCH = [*_PLACE, "words", "to_key", "to_doc", "to_start"]


def matches(docs: DataFrame, line_words: int = LINE_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For `docs` (key, doc, text): the paragraphs that repeat an earlier one, the distinct texts, and their own repeats.

    (key, doc, start, words, to_key, to_doc, to_start, whole); `whole` is false for the words around runs that complete a
    repeated passage, and for lines like one that repeats an earlier one itself. (doc, key, words): the first key of every text, and its words if it is a paragraph. (doc, start,
    words, why): ranges in which a text repeats itself, GONE, and what they repeat, STAY.
    """
    ship(docs.sparkSession)
    rows = stage(paragraphs(docs, line_words), "paragraphs")
    keys = docs.groupBy("doc").agg(F.min("key").alias("key"))
    whole = rows.where(F.col("kind") == TEXT).groupBy("doc").agg(F.min("words").alias("words"))
    contents = stage(keys.join(whole, "doc", "left"), "contents")
    named = contents.select("doc", "key")
    places = stage(_repeated(rows.where(F.col("kind").isin(LINE, RUN))).join(named, "doc"), "places")
    again = stage(_again(places, ["kind", "same"]), "again")
    own = rows.where(F.col("kind").isin(LOST, KEPT)).select("doc", "start", "words", F.when(F.col("kind") == LOST, GONE).otherwise(STAY).alias("why"))
    own = stage(own.distinct(), "own")
    lines = stage(rows.where(F.col("kind") == LINE).select("doc", "start", "words", "same", "bands", "hashes"), "lines")
    discard(rows)
    like = similar_lines(docs, lines, named)
    discard(lines)
    runs = F.col("kind") == RUN
    tails = ends(docs, places.where(runs), again.where(runs))
    # a line that is itself like an earlier one is no first occurrence: what it gives to later lines does not keep it
    gone = like.select(*(F.col(c).alias(f"to_{c}") for c in _PLACE)).distinct().withColumn("gone", F.lit(True))
    first = like.join(gone, [f"to_{c}" for c in _PLACE], "left").select(*_MATCH, F.col("gone").isNull().alias("whole"))
    parts = [again.select(*_MATCH, F.lit(True).alias("whole")), first, tails.withColumn("whole", F.lit(False))]
    out = reduce(DataFrame.unionByName, parts)
    out = stage(out, "matches")
    for done in (places, again, like):
        discard(done)
    return out, contents, own


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges in order, overlapping and touching ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def less(ranges: list[tuple[int, int]], kept: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """`ranges` without what `kept` covers; both merged."""
    out, k = [], 0
    for a, b in ranges:
        while k < len(kept) and kept[k][1] <= a:
            k += 1
        j = k
        while j < len(kept) and kept[j][0] < b:
            if a < kept[j][0]:
                out.append((a, kept[j][0]))
            a = max(a, kept[j][1])
            j += 1
        if a < b:
            out.append((a, b))
    return out


def spans(found: DataFrame, own_ranges: DataFrame) -> DataFrame:
    """(doc, removed ARRAY<STRUCT<s, e>>): the word ranges each text loses; texts that lose none are left out."""
    # What another text holds earlier may go whole: that text, or the one it repeats itself, keeps it. Of a text that
    # repeats itself the first occurrence stays, though later ones may overlap it, but for what another text holds earlier.
    other = F.col("doc") != F.col("to_doc")
    gone = found.select("doc", "start", "words", F.when(other, OTHER).otherwise(GONE).alias("why"))
    own = found.where("whole and doc = to_doc")
    stay = own.select("doc", F.col("to_start").alias("start"), "words", F.lit(STAY).alias("why"))
    # distinct places of one text: the list is as long as the text at most
    per = gone.union(stay).union(own_ranges).distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "words", "why")).alias("places"))

    def run(batches):
        for batch in batches:
            rows, keep = [], []
            doc, values = listed(batch.column(1))
            start, words, why = (values.field(c).to_numpy() for c in ("start", "words", "why"))
            places = list(zip(start.tolist(), (start + words).tolist(), why.tolist()))
            at = np.searchsorted(doc, np.arange(batch.num_rows + 1)).tolist()
            for i, (x, y) in enumerate(zip(at, at[1:])):
                of = [], [], []
                for a, b, k in places[x:y]:
                    of[k].append((a, b))
                left = less(merged(of[GONE] + of[OTHER]), less(merged(of[STAY]), merged(of[OTHER])))
                if left:
                    keep.append(i)
                    rows.append([{"s": a, "e": b} for a, b in left])
            kind_of = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(rows, kind_of)], ["doc", "removed"])

    return per.mapInArrow(run, "doc binary, removed array<struct<s:int,e:int>>")


def cuts(docs: DataFrame, found: DataFrame, contents: DataFrame, own_ranges: DataFrame) -> DataFrame:
    """(key, doc, removed): what each distinct row (key, doc) loses, copies all of it; rows that lose nothing are left out."""
    none = F.array().cast("array<struct<s:int,e:int>>")
    all_ = F.array(F.struct(F.lit(0).alias("s"), F.col("words").alias("e")))
    named = contents.select("doc", F.col("key").alias("first"), "words").join(spans(found, own_ranges), "doc", "left")
    lost = F.when(F.col("key") == F.col("first"), F.coalesce("removed", none)).when(F.col("words").isNotNull(), all_).otherwise(none)
    own = docs.select("key", "doc").distinct().join(named, "doc").select("key", "doc", lost.alias("removed"))
    return own.where(F.size("removed") > 0)


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", line_words: int = LINE_WORDS) -> DataFrame:
    """One row per document: (key, component_id, repeats BOOLEAN, n_removed LONG, removed ARRAY<STRUCT<s, e>>).

    component_id is the smallest key that chains of shared paragraphs reach; `repeats` is true where the document
    shares a paragraph with another one or repeats its own; `removed` are word ranges, end excluded.
    """
    own = own_columns(docs, key, text)
    found, contents, inside = matches(own, line_words)
    copies = own.select("key", "doc").distinct().join(contents.where("words is not null").select("doc", F.col("key").alias("b")), "doc")
    links = found.select(F.col("key").alias("a"), F.col("to_key").alias("b")).union(copies.select(F.col("key").alias("a"), "b"))
    links = stage(links.where("a <> b").distinct(), "links")
    member = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    root = stage(components(member, links, "node", "a", "b").select(F.col("node").alias("root_key"), F.col("component").alias("root")), "repeats")
    cut = stage(cuts(own, found, contents, inside).select(F.col("key").alias("cut_key"), F.col("doc").alias("cut_doc"), "removed"), "repeats")
    none = F.array().cast("array<struct<s:int,e:int>>")
    rows = docs.select(F.col(key).alias("own_key"), digest(F.col(text)).alias("own_doc"))
    rows = rows.join(root, F.col("own_key") == F.col("root_key"), "left")
    rows = rows.join(cut, (F.col("own_key") == F.col("cut_key")) & (F.col("own_doc") == F.col("cut_doc")), "left")
    return rows.select(
        F.col("own_key").alias(key),
        F.coalesce("root", "own_key").alias("component_id"),
        (F.col("root_key").isNotNull() | F.col("cut_key").isNotNull()).alias("repeats"),
        F.expr("aggregate(coalesce(removed, array()), 0L, (n, x) -> n + x.e - x.s)").alias("n_removed"),
        F.coalesce("removed", none).alias("removed"),
    )


def cut_words(text: str, removed: list[tuple[int, int]]) -> str:
    """`text` without the words of the given ranges and the white space before them."""
    at = [m.span() for m in _TEXT_WORD.finditer(text)]
    out, end = [], 0
    for s, e in removed:
        e = min(e, len(at))
        if s < e:
            out.append(text[end : at[s - 1][1] if s else 0])
            end = at[e - 1][1]
    return "".join([*out, text[end:]]).strip(" \t\n\r\v\f") if out else text


_TEXT_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str | None = "n_chars", line_words: int = LINE_WORDS) -> DataFrame:
    """`docs`, all columns and rows, with the removed ranges cut from the text and `chars`, if there, counted anew."""
    mine = own_columns(docs, key, text)
    found, contents, inside = matches(mine, line_words)
    cut = stage(cuts(mine, found, contents, inside).select(F.struct("key", "doc").alias("row"), "removed"), "cuts")
    discard(found)
    name, spot = fresh(docs, "cut_row"), fresh(docs, "cut_spans")
    own = fresh(docs, "cut_identity")
    marked = docs.withColumn(own, F.struct(F.col(key).alias("key"), digest(F.col(text)).alias("doc")))
    asked, whole = split_by_ids(marked, own, cut.select("row"))
    joined = asked.join(cut.select(F.col("row").alias(name), F.col("removed").alias(spot)), F.col(own) == F.col(name), "left").drop(own, name)

    def run(batches):
        for batch in slices(batches, text):
            lists = batch.column(batch.schema.get_field_index(spot)).to_pylist()
            old = strings(batch, text)
            new = [cut_words(t, [(x["s"], x["e"]) for x in r]) if r else t for t, r in zip(old, lists)]
            columns = []
            for field, c in zip(batch.schema, batch.columns):
                if field.name == text:
                    c = pa.array([n if r else o for n, r, o in zip(new, lists, c.to_pylist())], pa.string())
                elif field.name == chars:
                    c = pa.array([len(n) if r else o for n, r, o in zip(new, lists, c.to_pylist())], field.type)
                columns.append(c)
            kept = [i for i, f in enumerate(batch.schema) if f.name != spot]
            yield pa.RecordBatch.from_arrays([columns[i] for i in kept], names=[batch.schema[i].name for i in kept])

    return whole.drop(own).unionByName(joined.mapInArrow(run, docs.schema))
