"""The streaming steps on the event table, read as a stream and written to the shared folder until it is used up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions.clock import as_micros
from trackloom.queries.registry import DAY, HOUR, query, table
from trackloom.session import shared_dir
from trackloom.streaming import streams


def _events(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", "user_id", "event_type", as_micros("ts").alias("at"))


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return _events(spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet"))


def _drain(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/trackloom/{label}-{uuid.uuid4().hex}"
    run = df.writeStream.format("parquet").option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start(path)
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query(
    f"""
with e as (select user_id, epoch_us(ts) as at from events),
g as (select *, case when lag(at) over w is null or at - lag(at) over w > {DAY} then 1 else 0 end as s from e window w as (partition by user_id order by at)),
h as (select *, sum(s) over (partition by user_id order by at) as run from g),
c as (select *, (row_number() over (partition by user_id, run order by at) - 1) // 5 as chunk from h),
f as (select user_id, min(at) as start_at, max(at) as end_at from c group by user_id, run, chunk having count(*) = 5)
select user_id, row_number() over (partition by user_id order by start_at) - 1 as scene_no, start_at, end_at from f"""
)
def stream_scenes(spark, sf):
    """The events dealt to six files that overlap by a day, in shuffled order; a last file moves the watermark on."""
    e = _events(table(spark, sf, "events")).select("user_id", "at")
    first, last = e.agg(F.min("at"), F.max("at")).first()
    shaken = F.col("at") + F.pmod(F.xxhash64("user_id", "at"), F.lit(DAY))
    width = (last + DAY - first) // 6 + 1
    folder = f"{shared_dir(spark)}/trackloom/events-{uuid.uuid4().hex}"
    for k in range(6):
        part = e.where(F.floor((shaken - first) / width) == k)
        part.coalesce(1).sortWithinPartitions(F.xxhash64("at", "user_id")).write.mode("append").parquet(folder)
    end = e.limit(1).select("user_id", F.lit(last + 60 * DAY).alias("at"))
    end.coalesce(1).write.mode("append").parquet(folder)
    raw = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    # the closing frame itself stays in state: a scene of five never ends with it
    return _drain(streams.scenes_by_count(raw, "user_id", "at", 5, DAY, "2 days"), "scenes")


@query(
    f"""
with s as (select user_id, event_id as scene, epoch_us(ts) as s from events where event_type = 'purchase')
select event_id, scene from events e join s on e.user_id = s.user_id and epoch_us(e.ts) between s - {HOUR} and s + {DAY} + {HOUR}"""
)
def stream_fan_out(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'purchase'")
    spans = e.select("user_id", F.col("event_id").alias("scene"), as_micros("ts").alias("s")).withColumn("e", F.col("s") + DAY)
    out = streams.fan_out(_event_stream(spark, sf), spans, "user_id", "at", "s", "e", DAY, HOUR)
    return _drain(out.select("event_id", "scene"), "fanout")


@query(
    f"""
with m as (select user_id, event_id, epoch_us(ts) as at from events where event_type <> 'signup'),
s as (select user_id, event_id as span, epoch_us(ts) as s, epoch_us(ts) + cast(floor(value) as bigint) % 48 * {HOUR} as e from events where event_type = 'signup')
select event_id, span from m join s on m.user_id = s.user_id and at between s - {HOUR} and e + {HOUR}"""
)
def stream_spans(spark, sf):
    """Both sides as streams: signups open spans of up to two days, all other events are messages."""
    wide = table(spark, sf, "events").schema
    raw = lambda: spark.readStream.schema(wide).parquet(f"{sf}/events*.parquet")
    spans = raw().where("event_type = 'signup'").select("user_id", F.col("event_id").alias("span"), as_micros("ts").alias("s"), "value")
    spans = spans.select("user_id", "span", "s", (F.col("s") + F.floor("value").cast("long") % 48 * HOUR).alias("e"))
    out = streams.fan_out_streams(_events(raw()).where("event_type <> 'signup'"), spans, "user_id", "at", "s", "e", 2 * DAY, HOUR, "1 day")
    return _drain(out.select("event_id", "span"), "spans")
