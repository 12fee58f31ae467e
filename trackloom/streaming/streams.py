"""The stateful steps on unbounded streams: bursts, last-duplicate dedup, scenes by count, interval fan-out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def bursts(frames: DataFrame, key: str, ts: str, channel: str, channels: list[str], gap: str, late: str) -> DataFrame:
    """Capture instants as session windows: stamps at most `gap` apart belong together, one column per channel with
    its last stamp. A burst is final once the watermark (`late`) has passed it."""
    s = frames.withWatermark(ts, late).where(F.col(channel).isin(channels))
    grouped = s.groupBy(F.session_window(ts, gap), F.col(key))
    return grouped.agg(
        F.min(ts).alias("instant"), *[F.max(F.when(F.col(channel) == c, F.col(ts))).alias(c) for c in channels]
    ).drop("session_window")


def last_of_each(frames: DataFrame, keys: list[str], ts: str, seq: str, values: list[str], late: str) -> DataFrame:
    """One row per (keys, instant): the one recorded last, emitted when the watermark has passed the instant."""
    s = frames.withWatermark(ts, late)
    best = s.groupBy(*keys, ts).agg(F.max_by(F.struct(*values), seq).alias("_v"))
    return best.select(*keys, ts, *[F.col("_v")[v].alias(v) for v in values])


def scenes_by_count(
    frames: DataFrame, key: str, at: str, size: int, max_gap: int, late: str, per_second: int = 1_000_000, slices: int = 1024
) -> DataFrame:
    """Scenes of exactly `size` frames, whatever order the frames arrive in: (key, scene_no, start_at, end_at).

    Frames wait in state until the watermark (`late` behind the newest stamp, in whole milliseconds) has passed them,
    then they are taken in the order of their stamps, duplicates included; a timer does the same for keys that get
    no more data. A step above `max_gap` drops the open scene. State per key: the waiting stamps, that is those of the
    last `late`, and four numbers. The keys are dealt to `slices` by their hash and those of a slice are kept and called
    together, since a call costs more than the frames that a key gets between two; with many millions of keys take
    more. A frame behind the watermark cannot be placed any more: Spark leaves it out and counts it, `late_rows` gives
    the number. Keys are of a type that a cast to string and back preserves.
    """
    kind = frames.schema[key].dataType.simpleString()
    out = "key string, scene_no bigint, start_at bigint, end_at bigint"
    state = "key array<string>, last array<bigint>, n array<int>, start array<bigint>, scene array<bigint>, of array<int>, waiting array<bigint>"
    per_ms = per_second // 1_000

    def step(_: tuple, batches: Iterator[pd.DataFrame], st: GroupState) -> Iterator[pd.DataFrame]:
        keys, last, n, start, scene, of, waiting = map(list, st.get) if st.exists else ([] for _ in range(7))
        place = {k: i for i, k in enumerate(keys)}
        for b in batches:
            for k, t in zip(b["_key"].tolist(), b[at].tolist()):
                i = place.setdefault(k, len(place))
                if i == len(keys):
                    for column, first in ((keys, k), (last, None), (n, 0), (start, None), (scene, 0)):
                        column.append(first)
                of.append(i)
                waiting.append(int(t))
        passed = st.getCurrentWatermarkMs()
        edge = (passed + 1) * per_ms  # the watermark's own millisecond is passed too
        rows = []
        for t, i in sorted((t, i) for t, i in zip(waiting, of) if t < edge):
            if last[i] is None or t - last[i] > max_gap:
                n[i] = 0
            if n[i] == 0:
                start[i] = t
            n[i], last[i] = n[i] + 1, t
            if n[i] == size:
                rows.append((keys[i], scene[i], start[i], t))
                scene[i], n[i] = scene[i] + 1, 0
        left = [(t, i) for t, i in zip(waiting, of) if t >= edge]
        st.update((keys, last, n, start, scene, [i for _, i in left], [t for t, _ in left]))
        if left:
            st.setTimeoutTimestamp(max(min(left)[0] // per_ms, passed + 1))
        if rows:
            yield pd.DataFrame(rows, columns=["key", "scene_no", "start_at", "end_at"])

    stamped = frames.select(
        F.pmod(F.xxhash64(key), F.lit(slices)).alias("_slice"), F.col(key).cast("string").alias("_key"), at,
        F.timestamp_millis(F.floor(F.col(at) / per_ms)).alias("_at"),
    ).withWatermark("_at", late)
    found = stamped.groupBy("_slice").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.col("key").cast(kind).alias(key), "scene_no", "start_at", "end_at")


class LateRows(StreamingQueryListener):
    """Counts the rows that queries leave out because they came behind the watermark, over whole runs.

    Add it with `spark.streams.addListener` before a query starts; `rows` maps query ids to counts.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        p = event.progress
        self.rows[str(p.id)] = self.rows.get(str(p.id), 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def late_rows(run: StreamingQuery) -> int:
    """Rows of a query that came behind the watermark and were left out, as its last hundred batches count them; `LateRows`
    counts those of longer runs."""
    return sum(s.numRowsDroppedByWatermark for p in run.recentProgress for s in p.stateOperators)


def fan_out(messages: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, width: int, margin: int) -> DataFrame:
    """A message stream joined with a static table of spans: every span, widened by `margin`, that contains the message.

    Spans are filed under every bin of `width` they touch (pick it near the length of a span), messages look into one.
    """
    lo, hi = F.col(start) - margin, F.col(end) + margin
    bins = F.sequence(F.floor(lo / width), F.floor(hi / width))
    filed = spans.withColumn("_bin", F.explode(bins))
    asked = messages.withColumn("_bin", F.floor(F.col(at) / width))
    j = asked.join(filed, [key, "_bin"])
    return j.where((F.col(at) >= lo) & (F.col(at) <= hi)).drop("_bin")


def windows_by_time(frames: DataFrame, key: str, ts: str, width: str, late: str) -> DataFrame:
    """Frames per key and fixed stretch of time, final once the watermark (`late`) has passed it: (key, start, n, first, last)."""
    grouped = frames.withWatermark(ts, late).groupBy(F.window(ts, width).alias("_w"), F.col(key))
    counts = grouped.agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return counts.select(key, F.col("_w.start").alias("start"), "n", "first", "last")


def fan_out_streams(
    messages: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, longest: int, margin: int, late: str
) -> DataFrame:
    """Two streams: every message (`at`, microseconds) with every span of its key that contains it, widened by `margin`.

    Either side may come first, by up to `late` of event time. The state is bounded: a span is kept until no message of
    its time can come any more, a message until no span can. For that a span must not be longer than `longest`; a longer
    one stops the query, since its later messages would be lost silently. Spans that end before they start match
    nothing; rows without key or time are left out.
    """
    stamp = lambda c: F.timestamp_micros(F.col(c))
    told = F.when(F.col(end) - F.col(start) > longest, F.raise_error(F.lit(f"a span is longer than {longest}"))).otherwise(True)
    m = messages.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_at", stamp(at)).withWatermark("_at", late)
    s = spans.where(F.col(key).isNotNull() & F.col(start).isNotNull() & told.cast("boolean"))
    s = s.withColumnRenamed(key, "_key").withColumn("_start", stamp(start)).withWatermark("_start", late)
    near = F.expr(f"_at >= _start - interval {margin} microseconds and _at <= _start + interval {longest + margin} microseconds")
    inside = (F.col(at) >= F.col(start) - margin) & (F.col(at) <= F.col(end) + margin)
    return m.join(s, (F.col(key) == F.col("_key")) & near & inside).drop("_key", "_at", "_start")
