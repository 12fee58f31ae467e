"""The operators on the tables: one query each, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import (
    alignment, bit_files, decontaminate, html_text, lang_id, lexical, pii, quality_fm, quality_rules, simhash, substring, toxicity, word_table,
)
from trackloom.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: id that ends every document in the token files
END_ID = 2


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(fold_of: Column) -> Column:
    # a row without an id is in no fold
    return F.coalesce(fold_of, F.lit(False))


@query()
def op1_quality_fm(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = held_out(fold("doc_id", 5) == 0)
    model = quality_fm.train(docs, labels.where(~out))
    return toxicity.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


OP2 = r"""
with w as (
  select doc_id, lang, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
), grams as (
  select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from grams) where n > 1
), rep as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 5)) as p from twice) group by doc_id
), m as (
  select w.doc_id, lang, source, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
    cast(len(ls) as bigint) as n_lines
  from (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from w) w
  left join rep on rep.doc_id = w.doc_id
), r as (
  select *, word_chars * 100 // greatest(n_words, 1) as word_length, n_symbols * 10000 // greatest(word_chars, 1) as symbol_rate,
    n_dup_lines * 10000 // greatest(n_lines, 1) as dup_line_rate, n_repeat_words * 10000 // greatest(n_words, 1) as repeat_rate
  from m
), long as (
  select lang, source, rule, case when v <= 0 then 0 else 1 + cast(floor(ln(cast(v as double)) / ln(1.02)) as bigint) end as bucket
  from (unpivot r on word_length, symbol_rate, dup_line_rate, repeat_rate into name rule value v)
), fine as (select lang, source, rule, bucket, count(*) as n from long group by all),
levels as (
  select 0 as level, lang, source, rule, bucket, n from fine
  union all select 1, lang, null, rule, bucket, sum(n) from fine group by lang, rule, bucket
  union all select 2, null, null, rule, bucket, sum(n) from fine group by rule, bucket
), run as (
  select *, sum(n) over (partition by level, lang, source, rule order by bucket) as upto,
    sum(n) over (partition by level, lang, source, rule) as total,
    case when bucket = 0 then 0 else ceil(pow(1.02, bucket - 1) - 1e-9) end as low
  from levels
), q as (
  select level, lang, source, rule, any_value(total) as n, cast(min(low) filter (upto * 4 >= total) as bigint) as q1,
    cast(min(low) filter (upto * 4 >= total * 3) as bigint) as q3
  from run group by level, lang, source, rule
), pick as (
  select a.lang, a.source, a.rule,
    case when a.n >= 200 then a.q1 when b.n >= 200 then b.q1 else c.q1 end as q1,
    case when a.n >= 200 then a.q3 when b.n >= 200 then b.q3 else c.q3 end as q3
  from (select * from q where level = 0) a
  join (select * from q where level = 1) b on a.lang is not distinct from b.lang and a.rule = b.rule
  join (select * from q where level = 2) c on a.rule = c.rule
), f as (
  select lang, source,
    max(q3 + 3 * (q3 - q1) + 150) filter (rule = 'word_length') as wl_max, max(q1 - 3 * (q3 - q1) - 150) filter (rule = 'word_length') as wl_min,
    max(q3 + 3 * (q3 - q1) + 300) filter (rule = 'symbol_rate') as sr_max,
    max(q3 + 3 * (q3 - q1) + 2000) filter (rule = 'dup_line_rate') as dl_max,
    max(q3 + 3 * (q3 - q1) + 1000) filter (rule = 'repeat_rate') as rr_max
  from pick group by lang, source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and word_length between wl_min and wl_max
    and symbol_rate <= sr_max and dup_line_rate <= dl_max and repeat_rate <= rr_max as kept
from r join f on r.lang is not distinct from f.lang and r.source is not distinct from f.source
"""


@query(OP2)
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf, "documents"))


@query()
def op3_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return bit_files.digests(bit_files.write(table(spark, sf, "documents"), tokenizer_path(), END_ID))


@query()
def op4_word_table_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return word_table.round_trip(table(spark, sf, "documents"), tokenizer_path())


@query()
def op5_simhash_tiles(spark: SparkSession, sf: str) -> DataFrame:
    classes = simhash.near_classes(table(spark, sf, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op6_language_masks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = held_out(fold("doc_id", 3) == 1)
    model = lang_id.train(docs.where(~out))
    return lang_id.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query()
def op7_html_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


OP8 = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), win as (
  select distinct item_id, least(len(ws), 10) as k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as g
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from b where len(ws) > 0)
), sizes as (select distinct k from win),
spot as (
  select doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') as g
  from (select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) as i from d, sizes where len(ws) >= k)
), hit as (select spot.doc_id, spot.i, spot.k, win.item_id from spot join win on spot.k = win.k and spot.g = win.g),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hit) group by doc_id),
it as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as names
  from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id
)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n on d.doc_id = n.doc_id left join it on d.doc_id = it.doc_id
"""


@query(OP8)
def op8_prefix_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


@query()
def op9_paragraph_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return substring.find_repeats(table(spark, sf, "documents"))


@query()
def op10_toxicity_ftrl(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = held_out(fold("doc_id", 3) == 1)
    model = toxicity.train(docs, labels.where(~out))
    return toxicity.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query()
def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


OP12 = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents
), q as (
  select row_number() over () as q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from benchmark
), c as (select cast(count(*) as bigint) as docs, cast(sum(len(ws)) as bigint) as terms from d where len(ws) > 0),
tf as (select r, t, count(*) as tf from (select r, unnest(ws) as t from d) group by r, t),
w as (
  select t, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w from tf, c group by t
), s as (
  select q.q, q.item_id, tf.r, cast(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(d.ws) * c.docs) // c.terms)))) as bigint) as score
  from (select q, item_id, unnest(ws) as t from q) q join tf using (t) join w using (t) join d using (r), c
  group by q.q, q.item_id, tf.r
), k as (
  select item_id, doc_id, score, row_number() over (partition by q order by score desc, doc_id nulls last) as rank
  from s join d using (r) where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from k where rank <= 20
"""


@query(OP12)
def op12_hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query()
def op13_personal_crf(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digests(table(spark, sf, "documents"))
