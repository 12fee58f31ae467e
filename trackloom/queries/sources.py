"""Sources and sinks on files that Spark derives from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trackloom.functions.clock import as_micros
from trackloom.queries.registry import query, table
from trackloom.session import shared_dir
from trackloom.sources import json_array, recording


def _little_endian(c):
    """The four bytes of a 32-bit number, lowest first."""
    h = F.lpad(F.hex(c), 8, "0")
    return F.unhex(F.concat(*(F.substring(h, k, 2) for k in (7, 5, 3, 1))))


def _messages(spark, sf):
    """The events as messages of one recording per user: all types but errors begin with a header, stamped 5 ms earlier."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "props", (as_micros("ts") * 1000).alias("bag_ns"))
    stamp = F.col("bag_ns") - 5_000_000
    head = F.concat(_little_endian(F.col("event_id")), _little_endian(F.expr("(bag_ns - 5000000) div 1000000000")), _little_endian(stamp % 1_000_000_000))
    plain = F.col("event_type") == "error"
    return e.select(
        F.concat(F.lit("log-"), "user_id").alias("log"), F.concat(F.lit("/"), "event_type").alias("topic"),
        F.when(plain, "Plain").otherwise("Stamped").alias("kind"),
        F.when(plain, "uint32 seq\nstring props").otherwise("# one event\nHeader header\nstring props").alias("definition"), "bag_ns",
        F.concat(head, F.encode("props", "utf-8")).alias("payload"),
    )


_STAMPS = """
select 'log-' || user_id as log, '/' || event_type as topic, count(*) as messages, min(epoch_us(ts) * 1000) as first_ns, max(epoch_us(ts) * 1000) as last_ns,
  case when event_type = 'error' then null else cast(sum(epoch_us(ts) * 1000 % 1000003 - (epoch_us(ts) * 1000 - 5000000) % 1000003) as bigint) end as shift
from events {where} group by user_id, event_type"""


def _per_topic(df):
    # the stamps themselves add up beyond 64 bits
    shift = F.sum(F.col("bag_ns") % 1_000_003 - F.col("header_ns") % 1_000_003)
    return df.groupBy(F.substring_index("log", "~", 1).alias("log"), "topic").agg(
        F.count(F.lit(1)).alias("messages"), F.min("bag_ns").alias("first_ns"), F.max("bag_ns").alias("last_ns"), shift.alias("shift")
    )


def _recordings(spark, sf, compression):
    folder = f"{shared_dir(spark)}/trackloom/recordings-{uuid.uuid4().hex}"
    recording.register(spark)
    recording.write(_messages(spark, sf), folder, compression=compression, chunk_bytes=32 << 10).count()
    return spark.read.format("recording").option("path", folder)


@query(_STAMPS.format(where=""))
def recording_stamps(spark, sf):
    """Receive and header stamps per topic from the index records and message heads of written recordings."""
    return _per_topic(_recordings(spark, sf, "none").option("payload", False).load())


@query(_STAMPS.format(where="where event_type in ('click', 'error') and epoch_us(ts) >= 1704844800000000"))
def recording_payloads(spark, sf):
    """As recording_stamps, with payloads, from compressed chunks, for two topics and a range of time."""
    df = _recordings(spark, sf, "lz4").load()
    return _per_topic(df.where(F.col("topic").isin("/click", "/error") & (F.col("bag_ns") >= 1_704_844_800_000_000_000) & F.col("payload").isNotNull()))


@query(
    """select o_orderkey, o_custkey, o_orderpriority || '"}], [{\\' || o_orderstatus as note, o_totalprice, [o_orderstatus, '","'] as marks from orders"""
)
def json_array_rows(spark, sf):
    """The orders written as JSON arrays, with brackets, quotes and backslashes in strings, and read by ranges of 64 kB."""
    folder = f"{shared_dir(spark)}/trackloom/arrays-{uuid.uuid4().hex}"
    note = F.concat("o_orderpriority", F.lit('"}], [{\\'), "o_orderstatus").alias("note")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", note, "o_totalprice", F.array("o_orderstatus", F.lit('","')).alias("marks")
    )
    json_array.write(orders, folder).count()
    return json_array.read(spark, folder, orders.schema, range_bytes=64 << 10)
