"""Scene pairs: how far one scene's path covers another's, and distances between scene descriptions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.session import stage

REGION = 64  # cells a region is wide
POINTS = 400_000  # points of the scenes of a block
PAIRS = 1 << 18  # places and points compared at a time
FINE, FINEST = 16, 128  # places a cell is cut into, each way: at first, and at most where too many verdicts stay open
VAGUE = 0.3  # share of open verdicts that is too many
TURNS = 64  # kinds of headings told apart
VERDICTS = 1 << 26  # verdicts held at a time
FEW = 16  # points of a scene in and beside a cell that are compared one after the other
OPEN = 1 << 20  # undecided points looked at one by one at a time
TOGETHER = 1 << 21  # rows of a cover that meet the states of their scenes in one task
SURE, MAYBE = 1, 129  # a verdict; sums of up to 127 of them count both in their lower seven bits


def _cells(points: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return points.withColumn("_cx", F.floor(F.col(x) / size)).withColumn("_cy", F.floor(F.col(y) / size))


def _around(df: DataFrame) -> DataFrame:
    """Every row once for each of the 3 x 3 cells around its own."""
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return df.withColumn("_o", F.explode(offsets)).select(
        *[c for c in df.columns if c not in ("_cx", "_cy")],
        (F.col("_cx") + F.col("_o")["i"]).alias("_cx"),
        (F.col("_cy") + F.col("_o")["j"]).alias("_cy"),
    )


def _blocks(points: DataFrame, scene: str, x: str, y: str, reach: float, within: tuple[str, ...]) -> DataFrame:
    """(scene, _block): scenes that begin in one region, in blocks of some POINTS points."""
    cells = _cells(points, x, y, reach)
    home = F.struct((F.min("_cx").cast("double") / REGION).cast("long").alias("x"), (F.min("_cy").cast("double") / REGION).cast("long").alias("y"))
    scenes = cells.where("_cx is not null and _cy is not null").groupBy(scene, *within).agg(F.count(F.lit(1)).alias("_n"), home.alias("_home"))
    scenes = scenes.dropna(subset=[scene, *within])
    full = scenes.groupBy(*within, "_home").agg(F.sum("_n").alias("_all"))
    slices = F.ceil(F.col("_all") / POINTS)
    block = F.struct(*within, "_home", F.pmod(F.xxhash64(scene), slices).alias("slice"))
    return scenes.join(full, [*within, "_home"]).select(scene, block.alias("_block"))


def place_cover(
    points: DataFrame,
    scene: str,
    seq: str,
    x: str,
    y: str,
    heading: str,
    place_m: float = 10.0,
    heading_deg: float = 30.0,
    share: float = 0.8,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """(a, b, cover): share of a's points whose nearest point of b lies within place_m and heads within heading_deg.

    The heading test uses b's nearest point only (the first one on a tie). Pairs below `share` are left out, and
    with `within` those that differ in one of these columns.

    Scenes are put into blocks by place; two blocks meet if one has points in or beside a cell of the other. A task
    compares the scenes of a block with those of another, both ways, and passes on the pairs that reach `share`.
    A crowded place thus costs comparisons, but moves every point only once per block it meets.
    """
    blocks = stage(_blocks(points, scene, x, y, place_m, within), "blocks")
    pts = points.select(scene, F.col(seq).alias("_i"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), F.col(heading).cast("double").alias("_h"))
    pts = stage(pts.join(blocks, scene), "blocked")
    net = _cells(pts.where("_x is not null and _y is not null"), "_x", "_y", place_m).select("_block", "_cx", "_cy").distinct()
    net = stage(net, "net")
    same = [F.col("_block")[c].alias(f"_w{k}") for k, c in enumerate(within)]
    mine = _around(net.select(F.col("_block").alias("_a"), *same, "_cx", "_cy")).distinct()
    theirs = net.select(F.col("_block").alias("_b"), *same, "_cx", "_cy")
    met = mine.join(theirs, [*[f"_w{k}" for k in range(len(within))], "_cx", "_cy"]).where("_a <= _b").select("_a", "_b").distinct()
    met = stage(met.withColumn("_pair", F.monotonically_increasing_id()), "met")
    tasks = min(max(4 * met.count(), 1), 4096)
    ends = met.select("_pair", F.col("_a").alias("_block"), F.lit(True).alias("_left")).unionByName(
        met.where("_a <> _b").select("_pair", F.col("_b").alias("_block"), F.lit(False).alias("_left"))
    )
    sides = [scene, "_i", "_x", "_y", "_h"]
    both = ends.join(pts, "_block").select("_pair", "_left", *sides).repartition(tasks, "_pair")

    kind = points.schema[scene].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("cover", T.DoubleType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        a, b = (table.filter(m).select(sides) for m in (table["_left"], pc.invert(table["_left"])))
        for one, two in ((a, b), (b, a)) if len(b) else ((a, a),):
            for found in _covers(one, two, scene, place_m, heading_deg, share):
                yield from found.to_batches(max_chunksize=1 << 16)

    return both.groupBy("_pair").applyInArrow(compare, schema)


def _covers(a: pa.Table, b: pa.Table, scene: str, reach: float, turn: float, share: float) -> Iterator[pa.Table]:
    """The pairs (scene of a, scene of b) of two blocks whose cover reaches `share`.

    Points of a that stand close together and head alike share a verdict on each scene of b: all of them are covered by
    it, none is, or it takes a look at every one. Verdicts are summed per scene; only of pairs that may reach `share` the
    undecided points are compared one by one.
    """
    a, b = (t.take(pc.sort_indices(t, [(scene, "ascending"), ("_i", "ascending")])) for t in (a, b))
    names = [t.column(scene).combine_chunks().dictionary_encode() for t in (a, b)]
    code = [n.indices.to_numpy() for n in names]
    size = np.bincount(code[0], minlength=len(names[0].dictionary))
    xs, ys, hs = ([t.column(c).to_numpy() for t in (a, b)] for c in ("_x", "_y", "_h"))
    known = [np.isfinite(x) & np.isfinite(y) for x, y in zip(xs, ys)]
    known[0] &= np.isfinite(hs[0])
    code, xs, ys, hs = ([v[k] for v, k in zip(side, known)] for side in (code, xs, ys, hs))
    if not len(xs[0]) or not len(xs[1]):
        return
    cells = np.stack([np.floor(xs[1] / reach), np.floor(ys[1] / reach)], axis=1)
    ends = np.searchsorted(code[0], np.arange(len(size) + 1))
    least = np.maximum(np.ceil(share * size - 1e-6).astype(np.int64), 1)
    n_b, fine = len(names[1].dictionary), FINE
    while True:
        places = _Places(xs[0], ys[0], hs[0], reach, fine)
        fits, may = places.kinds(hs[1], turn)
        wide = int(np.clip(VERDICTS // len(places.row_place), 64, 4096))
        verdicts = np.zeros((len(places.row_place), min(wide, n_b)), np.uint8)
        part = slice(*np.searchsorted(code[1], [0, wide]))
        some = np.unique(np.linspace(0, len(places.cells) - 1, 8).astype(np.int64))  # a look at a few cells
        near = _windows(places, _by_cell(cells[part], np.arange(part.stop)), code[1][part], some)
        for cell, window in near.items():
            _judge(verdicts, places, cell, window, xs[1][part], ys[1][part], fits[part], may[part], reach)
        if fine >= FINEST or 2 * len(places.x) > len(xs[0]) or (verdicts == MAYBE).sum() <= VAGUE * np.count_nonzero(verdicts):
            break
        fine *= 2
    for low in range(0, n_b, wide):
        part = slice(*np.searchsorted(code[1], [low, low + wide]))
        b_code, b_x, b_y, b_h = code[1][part] - low, xs[1][part], ys[1][part], hs[1][part]
        near = _windows(places, _by_cell(cells[part], np.arange(len(b_code))), b_code, np.arange(len(places.cells)))
        verdicts[:] = 0
        for cell, window in near.items():
            _judge(verdicts, places, cell, window, b_x, b_y, fits[part], may[part], reach)

        def settled(held):
            """Exact counts of the pairs of some scenes, once their undecided points have been looked at."""
            one, two, count, point, col, pair = (np.concatenate(x) for x in zip(*held))
            good = _look(places, near, point, col, (xs[0], ys[0], hs[0]), (b_x, b_y, b_h), reach, turn)
            count = count - np.bincount(pair[~good], minlength=len(count))
            cover = count / size[one]
            some = (count > 0) & (cover >= share)
            first, second = names[0].dictionary.take(pa.array(one[some])), names[1].dictionary.take(pa.array(two[some] + low))
            out = pa.table({"a": first, "b": second, "cover": cover[some]})
            return out.filter(pc.not_equal(first, second))

        held, n_pairs, n_open = [], 0, 0
        for s in np.flatnonzero((np.diff(ends) >= least)):
            mine = places.row[ends[s] : ends[s + 1]]
            rows = verdicts.take(mine, axis=0)
            if len(mine) <= 127:
                most = np.add.reduce(rows, axis=0, dtype=np.uint8) & 127
            else:
                most = sum((np.add.reduce(rows[k : k + 127], axis=0, dtype=np.uint8) & 127).astype(np.int64) for k in range(0, len(mine), 127))
            cols = np.flatnonzero(most >= least[s])
            if not len(cols):
                continue
            point, at = np.nonzero(rows[:, cols] == MAYBE)
            held.append((np.full(len(cols), s), cols, most[cols].astype(np.int64), point + ends[s], cols[at], at + n_pairs))
            n_pairs, n_open = n_pairs + len(cols), n_open + len(at)
            if n_pairs + n_open > OPEN:
                yield settled(held)
                held, n_pairs, n_open = [], 0, 0
        if held:
            yield settled(held)


class _Places:
    """Points of a block by cell, by place in the cell and by kind of heading: a row per place and kind that occurs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, reach: float, fine: int):
        cx, cy = np.floor(x / reach), np.floor(y / reach)
        within = [np.clip(((v / reach - c) * fine).astype(np.int64), 0, fine - 1) for v, c in ((x, cx), (y, cy))]
        step = within[0] * fine + within[1]
        order = np.lexsort((step, cy, cx))
        new = np.diff(cx[order], prepend=np.nan) != 0
        new |= np.diff(cy[order], prepend=np.nan) != 0
        other = new | (np.diff(step[order], prepend=-1) != 0)
        self.place = np.empty(len(x), np.int64)  # of each point
        self.place[order] = np.cumsum(other) - 1
        start = np.flatnonzero(other)
        box = [f.reduceat(v[order], start) for v in (x, y) for f in (np.minimum, np.maximum)]
        self.x, self.y = (box[0] + box[1]) / 2, (box[2] + box[3]) / 2
        self.radius = np.hypot(box[1] - box[0], box[3] - box[2]) / 2
        first = np.flatnonzero(new[start])  # places that begin a cell
        self.cells = np.stack([cx, cy], axis=1)[order[start[first]]]
        self.bounds = np.append(first, len(start))
        self.cell = np.repeat(np.arange(len(first)), np.diff(self.bounds))  # of each place

        self.heads, kind = np.unique(h, return_inverse=True)
        self.half = np.zeros(len(self.heads))
        if len(self.heads) > TURNS:
            turned = np.mod(h, 360.0)
            _, kind = np.unique((turned * (TURNS / 360.0)).astype(np.int64).clip(0, TURNS - 1), return_inverse=True)
            low, high = np.full(kind.max() + 1, np.inf), np.full(kind.max() + 1, -np.inf)
            np.minimum.at(low, kind, turned)
            np.maximum.at(high, kind, turned)
            self.heads, self.half = (low + high) / 2, (high - low) / 2
            self.half += 1e-6 + 1e-12 * np.abs(h).max()
        rows, self.row = np.unique(self.place * len(self.heads) + kind, return_inverse=True)
        self.row_place, self.row_kind = np.divmod(rows, len(self.heads))
        self.row_bounds = np.searchsorted(self.row_place, np.arange(len(start) + 1))
        self.bits = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(self.heads) <= np.iinfo(t).bits)

    def kinds(self, h: np.ndarray, turn: float) -> tuple[np.ndarray, np.ndarray]:
        """For each heading a bit per kind: whether all headings of the kind lie within `turn` of it, whether one may."""
        slack = 1e-9 * (1 + np.abs(h[np.isfinite(h)]).max(initial=0.0))
        fits, may = np.zeros(len(h), self.bits), np.zeros(len(h), self.bits)
        for k, (head, half) in enumerate(zip(self.heads, self.half)):
            off, bit = _off(head, h), self.bits(1 << k)
            if half == 0:
                fits[off <= turn] |= bit
                may[off <= turn] |= bit
            else:
                fits[off + half + slack <= turn] |= bit
                may[off - half - slack <= turn] |= bit
        return fits, may


def _off(h: np.ndarray | float, other: np.ndarray) -> np.ndarray:
    """Degrees between headings."""
    with np.errstate(invalid="ignore"):
        off = np.fmod(h - other + 180, 360.0)
        return np.abs(np.where(off < 0, np.fmod(off + 360.0, 360.0), off) - 180)


def _windows(places: _Places, by_cell: dict, code: np.ndarray, some: np.ndarray) -> dict[int, tuple[np.ndarray, ...]]:
    """Of each of some cells that has points of the other side in or beside it: these points by scene and place in it, the scenes,
    their first points and how many there are."""
    out = {}
    for k, (cx, cy) in zip(some.tolist(), places.cells[some].tolist()):
        near = [by_cell[c] for c in ((cx + i, cy + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if c in by_cell]
        if near:
            j = np.sort(np.concatenate(near))
            start = np.flatnonzero(np.diff(code[j], prepend=-1))
            out[k] = j, code[j[start]], start, np.diff(start, append=len(j))
    return out


def _judge(verdicts, places: _Places, cell: int, window, xs, ys, fits, may, reach: float) -> None:
    """Verdicts of the rows of a cell on the scenes of its window.

    The nearest point of a scene to a point at most `radius` off the middle of its place is at most 2 `radius` farther
    from the middle than the scene's nearest one to it; if all such candidates agree, so does the nearest.
    """
    j, scenes, start, n = window
    order = np.argsort(-n, kind="stable")
    scenes, start, n = scenes[order], start[order], n[order]
    wide = np.searchsorted(-n, -np.arange(n[0]), side="left")  # scenes with more than l points
    deep = int(np.searchsorted(-wide, -8, side="right"))  # the l-th points of many scenes are taken together, the rest scene by scene
    parts = [(slice(0, w), j[start[:w] + k], False) for k, w in enumerate(wide[:deep].tolist())]
    parts += [(slice(q, q + 1), j[start[q] + deep : start[q] + n[q]], True) for q in range(int(wide[deep]) if deep < len(wide) else 0)]
    low, high = places.bounds[cell], places.bounds[cell + 1]
    ox, oy = places.x[low], places.y[low]
    near = [((xs[i] - ox).astype(np.float32), (ys[i] - oy).astype(np.float32)) for _, i, _ in parts]
    far = max(max(np.abs(u).max(), np.abs(v).max()) for u, v in near)
    slack = np.float32(1e-5 * (reach + far))
    step = max(1, PAIRS // len(j))
    one, full = places.bits(1), ~places.bits(0)
    for first in range(low, high, step):
        last = min(first + step, high)
        mx, my = ((v[first:last] - o).astype(np.float32)[:, None] for v, o in ((places.x, ox), (places.y, oy)))
        radius = places.radius[first:last].astype(np.float32)[:, None] + slack
        best = np.full((last - first, len(scenes)), np.inf, np.float32)  # squares up to the next comment
        away = []
        for (cols, _, whole), (u, v) in zip(parts, near):
            d, e = mx - u, my - v
            d *= d
            e *= e
            d += e
            away.append(d)
            np.minimum(best[:, cols], d.min(axis=1, keepdims=True) if whole else d, out=best[:, cols])
        np.sqrt(best, out=best)
        limit = (best + 2 * radius) ** 2
        some, lack = np.zeros(best.shape, places.bits), np.zeros(best.shape, places.bits)
        for (cols, i, whole), d in zip(parts, away):
            asked = (d <= limit[:, cols]).view(np.uint8)
            for into, bits in ((some, may[i]), (lack, ~fits[i])):
                met = asked * bits
                into[:, cols] |= np.bitwise_or.reduce(met, axis=1, keepdims=True) if whole else met
        some *= (best <= reach + radius).view(np.uint8)  # distances again
        lack |= (best > reach - radius).view(np.uint8) * full
        lack &= some
        both = np.zeros((2, last - first, verdicts.shape[1]), places.bits)
        both[0][:, scenes], both[1][:, scenes] = some, lack
        rows = slice(places.row_bounds[first], places.row_bounds[last])
        bit = np.left_shift(one, places.row_kind[rows].astype(places.bits))[:, None]
        some, lack = (((x.take(places.row_place[rows] - first, axis=0) & bit) != 0).view(np.uint8) for x in both)
        lack *= np.uint8(128)
        np.bitwise_or(some, lack, out=verdicts[rows])


def _look(places: _Places, near: dict, point, col, mine, theirs, reach: float, turn: float) -> np.ndarray:
    """Whether the nearest point of scene `col` covers a point, for each of some."""
    good = np.zeros(len(point), bool)
    cell = places.cell[places.place[point]]
    if len(places.cells) <= 1 << 16:
        cell = cell.astype(np.uint16)  # sorted by digits
    order = np.argsort(cell, kind="stable")
    cuts = np.flatnonzero(np.diff(cell[order])) + 1
    lookup = np.zeros(int(col.max(initial=-1)) + 1, np.int64)
    for part in np.split(order, cuts) if len(order) else []:
        j, scenes, start, n = near[int(cell[part[0]])]
        inside = scenes < len(lookup)
        lookup[scenes[inside]] = np.flatnonzero(inside)
        at = lookup[col[part]]
        x, y, h = (v[point[part]] for v in mine)
        best, turned = np.full(len(part), np.inf), np.full(len(part), np.nan)
        many = np.flatnonzero(n[at] > FEW)  # all points asked of such a scene at a time
        many = many[np.argsort(at[many], kind="stable")]
        for group in np.split(many, np.flatnonzero(np.diff(at[many])) + 1) if len(many) else []:
            q = at[group[0]]
            i = j[start[q] : start[q] + n[q]]
            step = max(1, PAIRS // len(i))
            for k in range(0, len(group), step):
                g = group[k : k + step]
                dx, dy = x[g][:, None] - theirs[0][i], y[g][:, None] - theirs[1][i]
                d = np.sqrt(dx * dx + dy * dy)
                to = d.argmin(axis=1)
                best[g], turned[g] = d[np.arange(len(g)), to], theirs[2][i[to]]
        left, k = np.flatnonzero(n[at] <= FEW), 0  # the others point by point
        start, n = start[at], n[at]
        while len(left):
            i = j[start[left] + k]
            dx, dy = x[left] - theirs[0][i], y[left] - theirs[1][i]
            d = np.sqrt(dx * dx + dy * dy)
            closer = d < best[left]
            best[left[closer]], turned[left[closer]] = d[closer], theirs[2][i[closer]]
            k += 1
            left = left[n[left] > k]
        good[part] = (best <= reach) & (_off(h, turned) <= turn)
    return good


def _by_cell(cells: np.ndarray, rows: np.ndarray) -> dict[tuple[float, float], np.ndarray]:
    """Rows of each cell, in their order."""
    order = np.lexsort((cells[:, 1], cells[:, 0]))
    cut = np.flatnonzero((np.diff(cells[order], axis=0) != 0).any(axis=1)) + 1
    return {tuple(cells[part[0]].tolist()): rows[part] for part in np.split(order, cut) if len(part)}


def ego_distance(v_a: str, w_a: str, v_b: str, w_b: str, s_v: float = 5.0, s_w: float = 2.0) -> Column:
    """RMS over the windows of the speed and yaw-rate differences of two scenes (array columns of equal length)."""

    def squares(p: str, q: str, unit: float) -> Column:
        terms = F.zip_with(p, q, lambda m, n: (m - n) * (m - n) / F.lit(unit * unit))
        return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)

    return F.sqrt((squares(v_a, v_b, s_v) + squares(w_a, w_b, s_w)) / F.size(v_a))


def behaviour_distance(a: str, b: str, units: dict[str, float]) -> Column:
    """RMS of the differences of two behaviour structs, each in its own unit."""
    terms = [((F.col(a)[f] - F.col(b)[f]) / u) ** 2 for f, u in units.items()]
    return F.sqrt(sum(terms[1:], terms[0]) / len(terms))


def composition_distance(veh_a: Column, vru_a: Column, veh_b: Column, vru_b: Column) -> Column:
    """Log-scale difference of nearby vehicles and nearby people or cycles; 0 where a side has no counts."""
    dv = (F.log1p(veh_a) - F.log1p(veh_b)) / 0.35
    dp = (F.log1p(vru_a) - F.log1p(vru_b)) / 0.7
    return F.coalesce(F.sqrt((dv * dv + dp * dp) / 2), F.lit(0.0))


def scene_distance(behaviour: Column, composition: Column) -> Column:
    return F.hypot(behaviour, composition)


def activity_distance(a: Column, b: Column, floor: float = 20.0) -> Column:
    """Log ratio of two change amounts, damped by `floor`."""
    return F.abs(F.log((a + floor) / (b + floor)))


def same_place_groups(
    cover: DataFrame, ego: DataFrame, scenes: DataFrame, scene: str, share: float = 0.8, tau: float = 1.0
) -> DataFrame:
    """(scene, component) of scenes chained by mutual cover and a like ego state; single scenes are left out.

    `cover` is directed (a, b, cover); `ego` holds (scene, win_v, win_w). Both rows of a pair meet the states of its scenes
    by blocks of scenes: a row of `cover` moves once, and without states; a state moves once per block.
    """
    from trackloom.operators.graph import components

    parts = math.ceil(math.sqrt(2 * cover.count() / TOGETHER)) or 1
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    meet = lambda p, q: (F.least(p, q) * parts + F.greatest(p, q)).alias("_meet")
    rows = cover.where((F.col("cover") >= share) & (F.col("a") != F.col("b"))).select(meet(block("a"), block("b")), "a", "b")
    kind = cover.schema["a"].dataType
    states = ego.select(F.col(scene).cast(kind).alias("_s"), *(F.col(c).cast("array<double>").alias(c) for c in ("win_v", "win_w"))).where("_s is not null")
    states = states.withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    states = states.select(meet(block("_s"), F.col("_q")), "_s", "win_v", "win_w")

    def like(pairs: pa.Table, states: pa.Table) -> pa.Table:
        return _alike(pairs, states, tau)

    schema = T.StructType([T.StructField(c, kind) for c in ("a", "b")])
    alike = rows.groupBy("_meet").cogroup(states.groupBy("_meet")).applyInArrow(like, schema)
    comp = components(scenes.select(scene), alike, scene, "a", "b")
    comp = stage(comp, "groups")
    big = comp.groupBy("component").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("component")
    return comp.join(big, "component", "left_semi").select(scene, "component")


def _alike(pairs: pa.Table, states: pa.Table, tau: float) -> pa.Table:
    """The pairs met both ways, once each, whose ego states differ by at most `tau`, as `ego_distance` has it."""
    names = states["_s"].combine_chunks().unique()
    at = [pc.index_in(pairs[c], value_set=names) for c in ("a", "b")]
    known = pc.and_(pc.is_valid(at[0]), pc.is_valid(at[1]))
    one, two = (c.filter(known).to_numpy().astype(np.int64) for c in at)
    key = np.sort((np.minimum(one, two) * len(names) + np.maximum(one, two)) * 2 + (one < two))
    key = key[np.diff(key, prepend=-1) != 0] // 2  # a pair met both ways comes twice
    one, two = np.divmod(key[1:][key[1:] == key[:-1]], max(len(names), 1))

    code = pc.index_in(states["_s"], value_set=names).to_numpy()
    order = np.argsort(code, kind="stable")
    n = np.bincount(code, minlength=len(names))
    start = np.cumsum(n) - n
    times = n[one] * n[two]  # more than 1 where a scene has several states
    pair = np.repeat(np.arange(len(one)), times)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
    i, j = order[start[one[pair]] + k // n[two[pair]]], order[start[two[pair]] + k % n[two[pair]]]

    total, equal, size = np.zeros(len(pair)), np.ones(len(pair), bool), None
    for column, unit in (("win_v", 5.0), ("win_w", 2.0)):
        values, length = _padded(states[column])
        squares = np.zeros(len(pair))
        for v in values:
            squares += (v[i] - v[j]) * (v[i] - v[j]) / (unit * unit)
        total += squares
        equal &= (length[i] == length[j]) & (length[i] > 0)
        size = length[i] if size is None else size
    near = pair[equal & (np.sqrt(total / np.maximum(size, 1)) <= tau)]
    near = near[np.diff(near, prepend=-1) != 0]
    return pa.table({"a": names.take(pa.array(one[near])), "b": names.take(pa.array(two[near]))})


def _padded(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values by place and row, lengths, -1 for a missing list): missing values are NaN, places behind the end 0."""
    lists = lists.combine_chunks()
    length = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    n = np.maximum(length, 0)
    values = np.zeros((n.max(initial=0), len(n)))
    row = np.repeat(np.arange(len(n)), n)
    values[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n), row] = lists.flatten().to_numpy(zero_copy_only=False)
    return values, length


def zero_shot(vectors: DataFrame, vector: str, prompts: dict[str, list[float]], scale: float = 100.0) -> DataFrame:
    """Softmax over scaled dot products with a fixed handful of prompt vectors: adds one probability per prompt."""
    dots = {}
    for name, p in prompts.items():
        weights = F.array(*[F.lit(float(x)) for x in p])
        dots[name] = F.aggregate(
            F.zip_with(F.col(vector), weights, lambda m, n: m.cast("double") * n), F.lit(0.0), lambda acc, t: acc + t
        )
    df = vectors.select("*", *[(d * scale).alias(f"_d_{n}") for n, d in dots.items()])
    top = F.greatest(*[F.col(f"_d_{n}") for n in prompts])
    df = df.withColumn("_top", top)
    exps = {n: F.exp(F.col(f"_d_{n}") - F.col("_top")) for n in prompts}
    total = sum(list(exps.values())[1:], list(exps.values())[0])
    return df.select(*vectors.columns, *[(e / total).alias(n) for n, e in exps.items()])
