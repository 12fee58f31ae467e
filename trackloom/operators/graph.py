"""Components, ordered greedy picks and pointer chains as rounds of joins, each round written to the shared folder."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.session import discard, stage


def _fingerprint(df: DataFrame, cols: list[str]) -> tuple:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"bit_xor(xxhash64({','.join(cols)}))").alias("x")).first()
    return r["n"], r["x"]


#: links that a task joins at a time before any are shuffled
FOREST = 1 << 17
_SORTED = ("tinyint", "smallint", "int", "bigint", "string", "binary")


def _forests(links: DataFrame) -> DataFrame:
    """Links (u, v), v < u, with the same components: those that stand near each other in a task become stars on their smallest node.

    At most one link per node and `FOREST` links is left. Kinds of nodes that Arrow orders unlike Spark stay as they are.
    """
    if links.schema["u"].dataType.simpleString() not in _SORTED:
        return links
    most = FOREST

    def stars(parts):
        table = pa.Table.from_batches(parts)
        u, v = (table[c].combine_chunks() for c in ("u", "v"))
        names = pa.concat_arrays([u, v]).unique().sort()
        a, b = (pc.index_in(x, names).to_numpy() for x in (u, v))
        low = np.arange(len(names))
        while (low[a] != low[b]).any():
            least = np.minimum(low[a], low[b])
            np.minimum.at(low, low[a], least)
            np.minimum.at(low, low[b], least)
            while (low != low[low]).any():
                low = low[low]
        at = np.flatnonzero(low != np.arange(len(low)))
        return pa.RecordBatch.from_arrays([names.take(pa.array(at)), names.take(pa.array(low[at]))], schema=parts[0].schema)

    def run(batches):
        parts, rows = [], 0
        for batch in batches:
            parts.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield stars(parts)
                parts, rows = [], 0
        if rows:
            yield stars(parts)

    return links.mapInArrow(run, links.schema)


def components(nodes: DataFrame, edges: DataFrame, node: str, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node of each connected component.

    Links that stand near each other are joined inside the tasks. Nodes with one link, to a smaller one, are set aside: their
    component is that of the smaller node. The links of the others alternate two star contractions until they stop changing:
    every node's larger neighbours are hung on its smallest neighbour, then the same for the smaller ones. Hubs are reduced by
    a map-side minimum, no neighbour list is ever gathered. The minima are written before they are joined to the links, so that
    both inputs of that join are plain exchanges, which Spark splits where a hub is skewed. A round's tables are deleted
    once the next one is written. A logarithmic number of rounds in practice.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    links = stage(_forests(links), "components")
    ends = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.lit(None).alias("v")))
    inner = F.max(F.col("v").isNull())  # a smaller end of some link
    per = stage(ends.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("_v"), inner.alias("_in")).where("v is not null"), "components")
    leaf = F.expr("v = _v and not _in")
    leaves = per.where(leaf).select("u", "v")
    core = stage(links.join(per.where(~leaf).select("u"), "u", "left_semi").distinct(), "components")
    discard(links)
    links, mark = core, _fingerprint(core, ["u", "v"])
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m")), "components")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "components")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        after = stage(small.where("u <> v").distinct(), "components")
        for done in (links, low, large, least):
            discard(done)
        links, now = after, _fingerprint(after, ["u", "v"])
        if now == mark:
            break
        mark = now
    root = links.groupBy("u").agg(F.min("v").alias("component"))
    hung = leaves.join(root.select(F.col("u").alias("v"), "component"), "v", "left").select("u", F.coalesce("component", "v").alias("component"))
    root = root.unionByName(hung).withColumnRenamed("u", node)
    return nodes.select(node).distinct().join(root, node, "left").select(
        node, F.coalesce("component", F.col(node)).alias("component")
    )


def greedy_keep(nodes: DataFrame, covers: DataFrame, node: str, rank: str, a: str, b: str) -> DataFrame:
    """What a one-by-one pass in `rank` order keeps: a node is dropped iff a node kept before it covers it.

    `covers` holds directed rows: `b` covers `a`. A round keeps every open node without an open coverer before it,
    drops what these cover, and carries on with the open nodes and the covers between them alone, so the result
    equals the sequential pass and settled rows are never read again. Returns (node, kept). Ranks must be distinct.
    """
    r = nodes.select(node, rank)
    edge = covers.select(F.col(a).alias(node), F.col(b).alias("_by")).distinct()
    edge = edge.join(r, node).join(r.select(F.col(node).alias("_by"), F.col(rank).alias("_by_rank")), "_by")
    if not edge.where((F.col(rank) == F.col("_by_rank")) & (F.col(node) != F.col("_by"))).isEmpty():
        raise ValueError("ranks are not distinct: the pass cannot be ordered")
    edge = stage(edge.where(F.col("_by_rank") < F.col(rank)).select(node, "_by"), "greedy")
    left = stage(r.select(node), "greedy")
    settled: list[DataFrame] = []
    while not left.isEmpty():
        kept = stage(left.join(edge, node, "left_anti"), "greedy")
        dropped = stage(edge.join(kept.select(F.col(node).alias("_by")), "_by", "left_semi").select(node).distinct(), "greedy")
        settled += [kept.withColumn("kept", F.lit(True)), dropped.withColumn("kept", F.lit(False))]
        gone = kept.union(dropped)
        more = stage(left.join(gone, node, "left_anti"), "greedy")
        closed = dropped.select(F.col(node).alias("_by"))
        open_edges = stage(edge.join(dropped, node, "left_anti").join(closed, "_by", "left_anti").select(node, "_by"), "greedy")
        discard(left)
        discard(edge)
        left, edge = more, open_edges
        if len(settled) > 32:
            settled = [stage(reduce(DataFrame.unionByName, settled), "greedy")]
    none = r.select(node, F.lit(True).alias("kept")).where(F.lit(False))
    return reduce(DataFrame.unionByName, settled, none)


def follow_chain(jumps: DataFrame, starts: DataFrame, node: str, to: str) -> DataFrame:
    """Every node reached from `starts` by following `to` again and again (null ends a chain).

    Pointer doubling: the reach grows from 2^k to 2^(k+1) steps per round, so a chain of n nodes takes log2(n).
    """
    reached = stage(starts.select(node).distinct(), "chain")
    hop = stage(jumps.where(F.col(to).isNotNull()).select(node, to), "chain")
    size = reached.count()
    while True:
        more = reached.join(hop, node).select(F.col(to).alias(node))
        reached = stage(reached.unionByName(more).distinct(), "chain")
        grown = reached.count()
        if grown == size:
            return reached
        size = grown
        second = hop.select(F.col(node).alias(to), F.col(to).alias("_far"))
        hop = stage(hop.join(second, to).select(node, F.col("_far").alias(to)), "chain")
