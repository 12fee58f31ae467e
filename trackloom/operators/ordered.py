"""Ordered scans that never put a whole series into one task.

A series (one key, ordered by an integer time) is cut into blocks of `span` time units. Windows run inside
(key, block); one summary row per block is scanned across blocks, and its carry is joined back. The only thing
ordered per key is the summary, one row per block, so a recording that holds a third of all rows still spreads
over as many tasks as it has blocks. Rows of one instant stay in one block; sensor streams have one row per
instant, and the joins in `asof` collapse repeated instants before they scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "_block"


@dataclass(frozen=True)
class Axis:
    """How a series is ordered: per `keys`, by the LONG column `at`, then by `tie`; blocks are `span` wide."""

    keys: tuple[str, ...]
    at: str
    span: int
    tie: tuple[str, ...] = ()
    ranked_by_at: bool = False  # the values scanned sit on distinct instants, so `at` alone ranks them

    def block(self) -> Column:
        return F.expr(f"(`{self.at}` - pmod(`{self.at}`, {self.span}L)) div {self.span}L")

    def rank(self) -> Column:
        return F.col(self.at) if self.ranked_by_at or not self.tie else F.struct(self.at, *self.tie)

    def window(self, back: bool = False) -> WindowSpec:
        cols = [F.col(c) for c in (self.at, *self.tie)]
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*[c.desc() if back else c for c in cols])


def fit_span(df: DataFrame, keys: list[str], at: str, span: int, rows: int = 1_000_000) -> int:
    """The given block width, halved as often as it takes until no (key, block) holds more than `rows` rows.

    One counting job per attempt; only the largest count reaches the driver. Stops at width 1, where a block is a
    single instant.
    """
    while span > 1:
        fullest = (
            df.groupBy(*keys, Axis(tuple(keys), at, span).block().alias(BLOCK)).count().agg(F.max("count")).first()[0]
        )
        if fullest is None or fullest <= rows:
            break
        span = max(1, span >> max(1, (fullest // rows).bit_length() - 1))
    return span


@dataclass(frozen=True)
class Step:
    """One running value of a scan; build with the functions below."""

    kind: str
    value: Column
    back: bool = False


def prev(value: Column | str) -> Step:
    """The previous row's value."""
    return Step("prev", _col(value))


def following(value: Column | str) -> Step:
    """The next row's value."""
    return Step("next", _col(value), back=True)


def latest(value: Column | str) -> Step:
    """Last non-null value at or before the row."""
    return Step("seen", _col(value))


def soonest(value: Column | str) -> Step:
    """First non-null value at or after the row."""
    return Step("seen", _col(value), back=True)


def running_sum(value: Column | str, back: bool = False) -> Step:
    return Step("sum", _col(value), back)


def running_max(value: Column | str, back: bool = False) -> Step:
    return Step("max", _col(value), back)


def running_min(value: Column | str, back: bool = False) -> Step:
    return Step("min", _col(value), back)


def position() -> Step:
    """1-based row number inside the key."""
    return Step("sum", F.lit(1).cast("long"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def scan(df: DataFrame, axis: Axis, steps: dict[str, Step]) -> DataFrame:
    """`df` plus one column per step. Keys must not be null; the order must be total for a stable result."""
    keys = list(axis.keys)
    names = list(steps)
    value = {n: f"_v{i}" for i, n in enumerate(names)}
    base = df.select(
        "*",
        axis.block().alias(BLOCK),
        *[
            (F.struct(s.value.alias("v")) if s.kind in ("prev", "next") else s.value).alias(value[n])
            for n, s in steps.items()
        ],
    )
    detail = base.select(
        *df.columns, BLOCK, *[_local(axis, s, value[n]).alias(f"_l{i}") for i, (n, s) in enumerate(steps.items())]
    )
    blocks = base.groupBy(*keys, BLOCK).agg(
        *[_summary(axis, s, value[n], base.schema[value[n]].dataType).alias(f"_b{i}") for i, (n, s) in enumerate(steps.items())]
    )
    carry = blocks.select(
        *keys, BLOCK, *[_carry(keys, s, f"_b{i}").alias(f"_c{i}") for i, s in enumerate(steps.values())]
    )
    joined = detail.join(carry, [*keys, BLOCK])
    return joined.select(
        *df.columns, *[_merge(s, f"_l{i}", f"_c{i}").alias(n) for i, (n, s) in enumerate(steps.items())]
    )


def _local(axis: Axis, s: Step, v: str) -> Column:
    w = axis.window(s.back)
    if s.kind in ("prev", "next"):
        return F.lag(v, 1).over(w)
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if s.kind == "seen":
        return F.last(v, ignorenulls=True).over(frame)
    return {"sum": F.sum, "max": F.max, "min": F.min}[s.kind](v).over(frame)


def _summary(axis: Axis, s: Step, v: str, dtype: T.DataType) -> Column:
    if s.kind in ("prev", "next", "seen"):
        return pick_by(F.col(v), dtype, axis.rank(), first=s.back)
    return {"sum": F.sum, "max": F.max, "min": F.min}[s.kind](v)


def pick_by(value: Column, dtype: T.DataType, rank: Column, first: bool) -> Column:
    """The non-null `value` of the lowest or highest rank. Struct fields are picked one by one, so that plain
    fields keep a hash aggregate (a struct buffer would force a sort of the input); ranks must be distinct."""
    pick, best = (F.min_by, F.min) if first else (F.max_by, F.max)
    ranked = F.when(value.isNotNull(), rank)
    if not isinstance(dtype, T.StructType):
        return pick(value, ranked)
    fields = [pick(value[f], ranked).alias(f) for f in dtype.names]
    return F.when(best(ranked).isNotNull(), F.struct(*fields))


def _across(keys: list[str], back: bool) -> WindowSpec:
    order = F.col(BLOCK).desc() if back else F.col(BLOCK)
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _carry(keys: list[str], s: Step, b: str) -> Column:
    w = _across(keys, s.back)
    if s.kind in ("prev", "next", "seen"):
        return F.last(b, ignorenulls=True).over(w)
    return {"sum": F.sum, "max": F.max, "min": F.min}[s.kind](b).over(w)


def _merge(s: Step, local: str, carry: str) -> Column:
    lo, ca = F.col(local), F.col(carry)
    if s.kind in ("prev", "next"):
        return F.coalesce(lo, ca)["v"]
    if s.kind == "seen":
        return F.coalesce(lo, ca)
    if s.kind == "sum":
        return F.when(ca.isNull(), lo).when(lo.isNull(), ca).otherwise(lo + ca)
    return F.greatest(lo, ca) if s.kind == "max" else F.least(lo, ca)


Starts = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def islands(
    df: DataFrame,
    axis: Axis,
    columns: list[str],
    starts: Starts,
    island: str = "island",
    place: str | None = None,
    size: str | None = None,
    counted: Callable[[Callable[[str], Column]], Column] | None = None,
) -> DataFrame:
    """Number the runs of a series: a row opens a new run when `starts(prev, cur)` holds; the first row always does.

    `prev` and `cur` give the named `columns` of the previous and the current row. `place` adds the 1-based
    position of the row in its run, `size` the run's length. With `counted(cur)`, only runs whose first row
    satisfies it take a number (the others repeat the last one). One pass: flags are local except for each
    block's first row, which the block summary settles.
    """
    keys = list(axis.keys)
    w = axis.window()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def field(struct: str) -> Callable[[str], Column]:
        return lambda name: F.col(struct)[name]

    def counts(struct: str) -> Column:
        return F.lit(1) if counted is None else F.when(counted(field(struct)), 1).otherwise(0)

    rows = df.select("*", axis.block().alias(BLOCK), F.struct(*columns).alias("_run_row"))
    rows = rows.select("*", F.lag("_run_row", 1).over(w).alias("_run_prev"), F.row_number().over(w).alias("_run_n"))
    opens = F.coalesce(starts(field("_run_prev"), field("_run_row")), F.lit(False))
    rows = rows.withColumn("_run_open", F.when(F.col("_run_prev").isNotNull() & opens, 1).otherwise(0))
    opened_at = F.when(F.col("_run_open") == 1, F.col("_run_n"))

    row_type = rows.schema["_run_row"].dataType
    blocks = rows.groupBy(*keys, BLOCK).agg(
        F.count(F.lit(1)).alias("_run_rows"),
        F.sum(F.col("_run_open") * counts("_run_row")).alias("_run_opens"),
        F.max(opened_at).alias("_run_last_open"),
        F.min(opened_at).alias("_run_first_open"),
        pick_by(F.col("_run_row"), row_type, axis.rank(), first=True).alias("_run_first"),
        pick_by(F.col("_run_row"), row_type, axis.rank(), first=False).alias("_run_last"),
    )
    step = Window.partitionBy(*keys).orderBy(BLOCK)
    before = step.rowsBetween(Window.unboundedPreceding, -1)
    later = _across(keys, back=True)
    blocks = blocks.withColumn("_run_before", F.lag("_run_last", 1).over(step))
    head = F.coalesce(starts(field("_run_before"), field("_run_first")), F.lit(False))
    blocks = blocks.withColumn("_run_head", F.when(F.col("_run_before").isNull() | head, 1).otherwise(0))
    blocks = blocks.withColumn("_run_heads", F.col("_run_head") * counts("_run_first"))
    blocks = blocks.withColumn("_run_offset", F.coalesce(F.sum("_run_rows").over(before), F.lit(0)))
    first_row = F.when(F.col("_run_head") == 1, 1)
    blocks = blocks.withColumn("_run_opened", F.coalesce("_run_last_open", first_row) + F.col("_run_offset"))
    blocks = blocks.withColumn("_run_opening", F.coalesce(first_row, "_run_first_open") + F.col("_run_offset"))
    carry = blocks.select(
        *keys,
        BLOCK,
        "_run_head",
        "_run_heads",
        "_run_offset",
        F.coalesce(F.sum(F.col("_run_opens") + F.col("_run_heads")).over(before), F.lit(0)).alias("_run_base"),
        F.last("_run_opened", ignorenulls=True).over(before).alias("_run_carried"),
        F.last("_run_opening", ignorenulls=True).over(later).alias("_run_next"),
        (F.sum("_run_rows").over(Window.partitionBy(*keys)) + 1).alias("_run_end"),
    )

    # by row number: rows that tie must stand in one order in both directions
    after = Window.partitionBy(*keys, BLOCK).orderBy(F.col("_run_n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    detail = rows.select(
        *df.columns,
        BLOCK,
        "_run_n",
        F.sum(F.col("_run_open") * counts("_run_row")).over(upto).alias("_run_opens_upto"),
        F.max(opened_at).over(upto).alias("_run_open_at"),
        *([F.min(opened_at).over(after).alias("_run_open_next")] if size else []),
    )
    out = detail.join(carry, [*keys, BLOCK])
    number = (F.col("_run_base") + F.col("_run_heads") + F.col("_run_opens_upto")).cast("long")
    result = [*df.columns, number.alias(island)]
    start = F.coalesce(
        F.col("_run_open_at") + F.col("_run_offset"),
        F.when(F.col("_run_head") == 1, F.col("_run_offset") + 1),
        F.col("_run_carried"),
    )
    if place:
        result.append((F.col("_run_n") + F.col("_run_offset") - start + 1).cast("long").alias(place))
    if size:
        end = F.coalesce(F.col("_run_open_next") + F.col("_run_offset"), "_run_next", "_run_end")
        result.append((end - start).cast("long").alias(size))
    return out.select(*result)


def row_frame(
    df: DataFrame,
    axis: Axis,
    before: int,
    after: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    rows_per_block: int = 65_536,
) -> DataFrame:
    """Windows over at most `before` rows back and `after` rows ahead, exact across blocks.

    Rows are numbered with `scan`, regrouped in equal blocks of rows, and the few rows near a border are copied
    to the neighbour block. `build(window)` returns the new columns; its frames must stay inside the reach.
    """
    size = max(rows_per_block, before + after + 1)
    keys = list(axis.keys)
    numbered = scan(df, axis, {"_pos": position()})
    inside = F.pmod(F.col("_pos") - 1, F.lit(size))
    shifts = F.array_compact(
        F.array(
            F.lit(0),
            F.when(inside >= size - before, F.lit(1)) if before else F.lit(None).cast("int"),
            F.when(inside < after, F.lit(-1)) if after else F.lit(None).cast("int"),
        )
    )
    copies = numbered.select("*", F.explode(shifts).alias("_shift"))
    copies = copies.withColumn("_part", F.expr(f"(_pos - 1) div {size}") + F.col("_shift"))
    w = Window.partitionBy(*keys, "_part").orderBy("_pos")
    cols = build(w)
    out = copies.select("*", *[c.alias(n) for n, c in cols.items()]).where(F.col("_shift") == 0)
    return out.select(*df.columns, *cols)
