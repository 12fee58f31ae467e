"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Each text is measured once. A measure that the rules look at is a whole number, and its sketch counts the values per
logarithmic bucket of 2 % width: sketches of any parts merge by adding counts, in any order, with one result. A
stratum (language, source) with fewer than `least` documents takes its language's merged sketch, and a language with
fewer takes the sketch of all. The thresholds are fences: the upper quartile plus `reach` times the distance between
the quartiles plus a slack, and likewise below; they are joined back to the documents they belong to.

Defined cases: a null text has no words and fails the base rule; null languages and sources are strata of their own;
a threshold needs no minimum of values, an empty table gives an empty result; repeated rows are judged one by one;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import ship, slices, texts
from trackloom.session import stage

SYMBOLS = b"#*$%&|<>"
WIDTH = 5  # words in a repeated window
#: bucket width of the sketches
GAMMA = 1.02
#: measure -> (slack added to the upper fence, slack taken from the lower fence; None: no fence on that side)
RULES: dict[str, tuple[int | None, int | None]] = {
    "word_length": (150, 150),  # hundredths of a character
    "symbol_rate": (300, None),  # per 10,000 characters
    "dup_line_rate": (2_000, None),  # per 10,000 lines with a word
    "repeat_rate": (1_000, None),  # per 10,000 words
}


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of one text."""
    words = text.split()
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    lines = [ln for ln in text.split(b"\n") if ln.strip()]
    grams = list(zip(*(words[i:] for i in range(WIDTH))))
    repeated = 0
    if len(set(grams)) < len(grams):
        seen = Counter(grams)
        end = 0  # words before it are counted
        for i, g in enumerate(grams):
            if seen[g] > 1:
                repeated += i + WIDTH - max(end, i)
                end = i + WIDTH
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measures(docs: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """(key, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    ship(docs.sparkSession)
    docs = docs.select(key, lang, source, text)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def run(batches):
        for batch in slices(batches, text):
            got = list(zip(*map(measure, texts(batch, text))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array(c, pa.int64()) for c in got)],
                [key, lang, source, *names],
            )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, lang, source))
    return docs.mapInArrow(run, kept + "".join(f", {n} long" for n in names))


def rated() -> dict[str, Column]:
    """The measures the rules look at, as whole numbers."""
    rate = lambda a, b, unit: F.expr(f"{a} * {unit} div greatest({b}, 1)")
    return {
        "word_length": rate("word_chars", "n_words", 100),
        "symbol_rate": rate("n_symbols", "word_chars", 10_000),
        "dup_line_rate": rate("n_dup_lines", "n_lines", 10_000),
        "repeat_rate": rate("n_repeat_words", "n_words", 10_000),
    }


def bucket(value: Column) -> Column:
    """0 for 0, else the number of the logarithmic bucket, from 1."""
    return F.when(value <= 0, 0).otherwise(1 + F.floor(F.log(value.cast("double")) / F.lit(math.log(GAMMA)))).cast("long")


def sketch(values: DataFrame, by: list[str]) -> DataFrame:
    """(by, rule, bucket, n): the mergeable sketch of every rule's measure; values has one column per rule."""
    long = values.select(
        *by, F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bucket(F.col(r)).alias("bucket")) for r in RULES])).alias("m")
    )
    return long.groupBy(*by, F.col("m.rule").alias("rule"), F.col("m.bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(parts: DataFrame, by: list[str]) -> DataFrame:
    """Add sketches up to coarser strata."""
    return parts.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, rule, n, q1 LONG, q3 LONG): the lower ends of the buckets that hold ranks n/4 and 3n/4."""
    w = Window.partitionBy(*by, "rule").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(*by, "rule")
    run = sketches.select(*by, "rule", "bucket", F.sum("n").over(w).alias("upto"), F.sum("n").over(total).alias("n"))
    # a bucket's lower end, rounded up to the whole number that can lie in it
    low = F.when(F.col("bucket") == 0, 0).otherwise(F.ceil(F.pow(F.lit(GAMMA), F.col("bucket") - 1) - 1e-9))
    at = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("n") * share, low)).cast("long")
    return run.groupBy(*by, "rule").agg(F.first("n").alias("n"), at(1).alias("q1"), at(3).alias("q3"))


def thresholds(values: DataFrame, lang: str, source: str, least: int, reach: int) -> DataFrame:
    """(lang, source, <rule>_min, <rule>_max): one row per stratum; null where a rule has no fence."""
    fine = stage(sketch(values, [lang, source]), "sketch")
    by_lang, every = merge(fine, [lang]), merge(fine, [])
    own = quartiles(fine, [lang, source])
    of_lang = quartiles(by_lang, [lang]).select(
        F.col(lang).alias("_l"), F.col("rule").alias("_r"), F.col("n").alias("n_l"), F.col("q1").alias("q1_l"), F.col("q3").alias("q3_l")
    )
    of_all = quartiles(every, []).select(F.col("rule").alias("_ra"), F.col("q1").alias("q1_a"), F.col("q3").alias("q3_a"))
    own = own.join(of_lang, F.col(lang).eqNullSafe(F.col("_l")) & (F.col("rule") == F.col("_r"))).join(
        of_all, F.col("rule") == F.col("_ra")
    )
    pick = lambda q: F.when(F.col("n") >= least, F.col(q)).when(F.col("n_l") >= least, F.col(f"{q}_l")).otherwise(F.col(f"{q}_a"))
    own = own.select(lang, source, "rule", pick("q1").alias("q1"), pick("q3").alias("q3"))
    wide = own.withColumn("span", (F.col("q3") - F.col("q1")) * reach)
    fences = []
    for rule, (above, below) in RULES.items():
        here = F.col("rule") == rule
        if above is not None:
            fences.append(F.max(F.when(here, F.col("q3") + F.col("span") + above)).alias(f"{rule}_max"))
        if below is not None:
            fences.append(F.max(F.when(here, F.col("q1") - F.col("span") - below)).alias(f"{rule}_min"))
    return wide.groupBy(lang, source).agg(*fences)


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    least: int = 200, reach: int = 3,
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept); one row per document."""
    m = stage(measures(docs, key, text, lang, source), "measures").withColumns(rated())
    t = thresholds(m, lang, source, least, reach).select(
        F.col(lang).alias("_l"), F.col(source).alias("_s"), *[c for r in RULES for c in (f"{r}_min", f"{r}_max") if RULES[r][c.endswith("_min")] is not None]
    )
    # written: joined to a stratum with a third of all documents, both inputs can be split
    t = stage(t, "thresholds")
    fine = F.lit(True)
    for rule, (above, below) in RULES.items():
        if above is not None:
            fine = fine & (F.col(rule) <= F.col(f"{rule}_max"))
        if below is not None:
            fine = fine & (F.col(rule) >= F.col(f"{rule}_min"))
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return m.join(t, F.col(lang).eqNullSafe(F.col("_l")) & F.col(source).eqNullSafe(F.col("_s"))).select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & fine).alias("kept"),
    )
