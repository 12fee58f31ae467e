"""Language identification with language-bitmask n-gram filters.

Training counts letter trigrams (word edges as spaces) per language over all training texts. A language owns a trigram
if its share there is at least `share` of the largest share any language has. The filter is a bit-sliced Bloom filter:
one array of masks, bit l of a mask belongs to language l, and the languages that contain a trigram are the AND of the
masks at its hash positions. A text's score per language is its popcount over all trigrams, corrected for the false
positives that the fill of this language's slice predicts; the largest decides.

Defined cases: null texts and texts without a letter are `und` with score 0; a text with letters always gets a learned
language, the most frequent one if no trigram is known; equal counts go to the first language in order; without
training rows everything is `und`; training rows without a language are left out; extra columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import mix, ship, slices, strings
from trackloom.session import stage

UND = "und"
HASHES = 3
#: the filter has at most so many positions, whatever the corpus
MOST_BITS = 24


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram codes, document of each, letters per document). A code holds three code points of 21 bits."""
    low = [d.lower() for d in docs]
    sizes = np.array([len(d) + 1 for d in low])
    points = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(low)), sizes)
    letter = _letters()[points]
    # of each run of other characters one place stays, as a space
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    chars = np.where(letter, points, 32)[keep].astype(np.uint64)
    of, letter = of[keep], letter[keep]
    n_letters = np.bincount(of[letter], minlength=len(low))
    if len(chars) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), n_letters
    # the first word of a text has an edge too: the place before it ends the text before
    left = np.concatenate([[np.uint64(32)], chars[:-2]])
    left[np.concatenate([[True], of[1:-1] != of[:-2]])] = 32
    inner = letter[:-1] & (of[1:] == of[:-1])
    codes = (left << np.uint64(42)) | (chars[:-1] << np.uint64(21)) | chars[1:]
    return codes[inner], of[:-1][inner], n_letters


#: trigrams that a task counts before it passes them on
HELD = 1 << 17


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram LONG, n LONG) over all rows with a language.

    A small slice of texts is cut into trigrams at a time, which take some 80 bytes for each character; their counts are
    kept over several slices.
    """
    ship(docs.sparkSession)

    def added(parts):
        if len(parts) == 1:
            return parts[0]
        grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        total = np.zeros(len(grams), np.int64)
        np.add.at(total, at, np.concatenate([n for _, n in parts]))
        return grams, total

    def counted(held):
        for tag, parts in held.items():
            grams, n = added(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tag] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())],
                ["lang", "gram", "n"],
            )

    def run(batches):
        held, rows = {}, 0
        for batch in slices(batches, text):
            tags, of = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            codes, doc, _ = trigrams(strings(batch, text))
            of = of[doc]
            for k, tag in enumerate(tags.tolist()):
                grams, n = np.unique(codes[of == k], return_counts=True)
                held.setdefault(tag, []).append((grams, n))
                rows += len(grams)
            if rows >= HELD:
                yield from counted(held)
                held, rows = {}, 0
        yield from counted(held)

    rows = docs.select(F.col(lang).cast("string").alias(lang), text).where(F.col(lang).isNotNull())
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The languages, their bit-sliced filter and each slice's false-positive rate."""

    def __init__(self, langs: list[str], bits: int, masks: np.ndarray, default: int):
        self.langs, self.bits, self.masks, self.default = langs, bits, masks, default
        ones = np.array([int((masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)).sum()) for k in range(len(langs))])
        self.false = (ones / (1 << bits)) ** HASHES

    def contained(self, codes: np.ndarray) -> np.ndarray:
        """One mask per word of 64 languages and trigram: who contains it."""
        out = None
        for p in positions(codes, self.bits):
            got = self.masks[:, p]
            out = got if out is None else out & got
        return out

    def predict(self, docs: list[str]) -> tuple[list[str], np.ndarray]:
        codes, of, letters = trigrams(docs)
        n = np.bincount(of, minlength=len(docs)).astype(float)
        if not self.langs:
            return [UND] * len(docs), np.zeros(len(docs))
        masks = self.contained(codes)
        share = np.zeros((len(self.langs), len(docs)))
        for k in range(len(self.langs)):
            hit = (masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            count = np.bincount(of, weights=hit.astype(float), minlength=len(docs))
            share[k] = np.clip((count - n * self.false[k]) / max(1e-9, 1 - self.false[k]), 0, None)
        best = share.argmax(axis=0)
        top, total = share.max(axis=0), share.sum(axis=0)
        best[top <= 0] = self.default
        score = np.where(total > 0, top / np.maximum(total, 1e-9), 0.0)
        known = letters > 0
        return [self.langs[b] if k else UND for b, k in zip(best, known)], np.where(known, score, 0.0)


def positions(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(codes.astype(np.uint64))
    g = mix(h) | np.uint64(1)
    return [((h + np.uint64(i) * g) >> np.uint64(64 - bits)).astype(np.int64) for i in range(HASHES)]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", share: float = 0.3, least: int = 3) -> Filters:
    """Fit on all rows of `docs`. What reaches the driver is the filter: at most 2**MOST_BITS masks."""
    counts = stage(gram_counts(docs, text, lang), "langid")
    sizes = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Filters([], 1, np.zeros((1, 2), np.uint64), 0)
    spark = docs.sparkSession
    total = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, float(v))])[F.col("lang")]
    rate = counts.where(F.col("n") >= least).withColumn("p", F.col("n") / total)
    top = rate.groupBy("gram").agg(F.max("p").alias("top"))
    number = F.create_map(*[F.lit(x) for i, k in enumerate(langs) for x in (k, i)])[F.col("lang")]
    own = stage(
        rate.join(top, "gram").where(F.col("p") >= share * F.col("top")).select("gram", number.cast("int").alias("l")), "langid"
    )
    largest = own.groupBy("l").count().agg(F.max("count")).first()[0] or 1
    bits = min(MOST_BITS, max(12, int(largest * HASHES * 4).bit_length()))
    ship(spark)

    def place(batches):
        for batch in batches:
            codes = batch.column(0).to_numpy().view(np.uint64)
            l = batch.column(1).to_numpy()
            mask = np.uint64(1) << (l % 64).astype(np.uint64)
            for p in positions(codes, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((l // 64).astype(np.int32)), pa.array(p), pa.array(mask.view(np.int64))], ["word", "at", "mask"]
                )

    cells = own.mapInArrow(place, "word int, at long, mask long").groupBy("word", "at").agg(F.bit_or("mask").alias("mask"))
    masks = np.zeros((-(-len(langs) // 64), 1 << bits), np.uint64)
    got = cells.toArrow()
    masks[got["word"].to_numpy(), got["at"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return Filters(langs, bits, masks, max(range(len(langs)), key=lambda i: (sizes[langs[i]], -i)))


def predict(docs: DataFrame, model: Filters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred STRING, score DOUBLE)."""
    spark = docs.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast(model)
    docs = docs.select(key, text)

    def run(batches):
        for batch in slices(batches, text):
            tags, score = share.value.predict(strings(batch, text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tags, pa.string()), pa.array(score)], [key, "lang_pred", "score"])

    return docs.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Filters, text: str = "text", margin: float = 1.08) -> DataFrame:
    """The documents, all columns, that are in some language: they have a letter, and the best language's score is at
    least `margin` times the score that all languages would share alike (any score if only one was learned)."""
    spark = docs.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast(model)
    least = margin / len(model.langs) if len(model.langs) > 1 else 0.0

    def run(batches):
        for batch in slices(batches, text):
            tags, score = share.value.predict(strings(batch, text))
            yield batch.filter(pa.array([t != UND and s >= least for t, s in zip(tags, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
