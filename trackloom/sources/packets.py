"""LiDAR packets to points: sweeps numbered by a scan, packets decoded as arrays inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.ordered import Axis, latest, running_sum, scan
from trackloom.sources.points import COLUMNS

UNIT = np.pi / 18000.0  # packet angles count hundredths of a degree
INFO_ID = bytes([0xA5, 0xFF, 0x00, 0x5A, 0x11, 0x11, 0x55, 0x55])


@dataclass(frozen=True)
class Spinning:
    """A spinning sensor's packet layout: bytes, metres, microseconds."""

    data_id: bytes
    length: int
    header: int
    blocks: int
    block_mark: bytes
    channels: int
    resolution: float
    near: float
    far: float
    lens: tuple[float, float]
    block_us: float
    firing_us: tuple[float, ...]
    vertical: int
    horizontal: int
    reversal: int | None = None
    block_prefix: int = 4


# Firing offset of each of the 128 channels within a block (microseconds)
FIRING_128 = (
    0.0, 0.0, 0.0, 0.0, 1.13, 1.13, 1.13, 1.13, 2.13, 2.13, 2.13, 2.13, 3.26, 3.26, 3.26, 3.26,
    4.26, 4.26, 4.26, 4.26, 5.38, 5.38, 5.38, 5.38, 6.38, 6.38, 6.38, 6.38, 7.51, 7.51, 7.51, 7.51,
    8.51, 8.51, 8.51, 8.51, 10.01, 10.01, 10.01, 10.01, 11.38, 11.38, 11.38, 11.38, 13.31, 13.31, 13.31, 13.31,
    15.11, 15.11, 15.11, 15.11, 17.04, 17.04, 17.04, 17.04, 18.85, 18.85, 18.85, 18.85, 21.14, 21.14, 21.14, 21.14,
    21.14, 23.31, 23.31, 23.31, 23.31, 25.61, 25.61, 25.61, 25.61, 27.78, 27.78, 27.78, 27.78, 30.07, 30.07, 30.07,
    30.07, 32.24, 32.24, 32.24, 32.24, 34.54, 34.54, 34.54, 34.54, 36.7, 36.7, 36.7, 36.7, 38.64, 38.64, 38.64,
    38.64, 40.44, 40.44, 40.44, 40.44, 41.94, 41.94, 41.94, 41.94, 43.3, 43.3, 43.3, 43.3, 44.8, 44.8, 44.8,
    44.8, 46.17, 46.17, 46.17, 46.17, 47.66, 47.66, 47.66, 47.66, 49.03, 49.03, 49.03, 49.03, 50.53, 50.53, 53.771,
)
# Firing offsets of the 32-channel dome sensor, both hardware generations (microseconds)
FIRING_DOME = (
    0.00, 2.56, 5.12, 7.68, 10.24, 12.80, 15.36, 17.92, 25.68, 28.24, 30.80, 33.36, 35.92, 38.48, 41.04, 43.60,
    1.28, 3.84, 6.40, 8.96, 11.52, 14.08, 16.64, 19.20, 26.96, 29.52, 32.08, 34.64, 37.20, 39.76, 42.32, 44.88,
)
FIRING_DOME_NEW = (
    0.00, 1.67, 3.34, 5.00, 6.67, 8.34, 10.01, 11.68, 13.34, 15.01, 16.68, 18.35, 20.02, 21.68, 23.35, 25.02,
    26.69, 28.36, 30.02, 31.69, 33.36, 35.03, 36.70, 38.36, 40.03, 41.70, 43.37, 45.04, 46.70, 48.37, 50.04, 51.71,
)
# Packet layouts
WIDE = Spinning(
    bytes([0x55, 0xAA, 0x05, 0x5A]), 1248, 80, 3, bytes([0xFE]), 128, 0.005, 0.4, 250.0, (0.02892, 0.0), 55.56, FIRING_128, 468, 852
)
DOME = Spinning(
    bytes([0x55, 0xAA, 0x05, 0x0A, 0x5A, 0xA5, 0x50, 0xA0]), 1248, 42, 12, bytes([0xFF, 0xEE]), 32, 0.005, 0.1, 150.0,
    (0.01473, 0.09427), 55.52, FIRING_DOME, 468, 564, 337,
)
DOME_NEW = Spinning(
    DOME.data_id, 1248, 42, 12, DOME.block_mark, 32, 0.0025, 0.1, 150.0, (0.01619, 0.09571), 55.56, FIRING_DOME_NEW, 468, 564, 337
)
# Packet layout of the solid-state sensor, whose returns carry their own angles
SOLID = {
    "data_id": bytes([0x55, 0xAA, 0x5A, 0xA5]), "length": 1210, "header": 32, "blocks": 25, "block": 47, "channels": 5,
    "resolution": 0.005, "near": 0.2, "far": 200.0, "zero": 32768,
}


def _calibrates(data: Column, model: Spinning) -> Column:
    """Whether an information packet is whole and holds valid angles only (a sign byte of 0xFF marks an invalid one)."""
    signs = [o + 3 * i for o in (model.vertical, model.horizontal) for i in range(model.channels)]
    valid = F.forall(F.array(*[F.lit(i + 1) for i in signs]), lambda i: F.substring(data, i, F.lit(1)) != F.lit(bytearray([0xFF])))
    return (F.substring(data, 1, len(INFO_ID)) == F.lit(bytearray(INFO_ID))) & (F.length(data) >= model.length) & valid


def number_sweeps(
    packets: DataFrame, keys: list[str], at: str, begins: str, seq: str, span: int, data_id: bytes, length: int,
    model: Spinning | None = None,
) -> DataFrame:
    """Data packets with `frame`, counted up at every packet that begins a sweep, and `info`, the last valid
    information packet before them.

    `packets`: keys, at (ns), seq, data, `begins`. With a `model`, packets before any valid information packet are
    left out, as they cannot be placed; short information packets and such with invalid angles change nothing. The
    scan carries the place of the information packet, its bytes are joined back once.
    """
    is_data = (F.substring("data", 1, len(data_id)) == F.lit(bytearray(data_id))) & (F.length("data") >= length)
    valid = _calibrates(F.col("data"), model) if model else F.lit(False)
    rows = packets.select(
        *keys, at, seq, "data", is_data.alias("_is_data"), F.when(valid, F.struct(F.col(at).alias("at"), F.col(seq).alias("seq"))).alias("_info"),
        F.when(is_data & F.col(begins), 1).otherwise(0).alias("_begin"),
    )
    s = scan(rows, Axis(tuple(keys), at, span, (seq,)), {"_place": latest("_info"), "frame": running_sum("_begin")})
    s = s.where("_is_data")
    if model is None:
        return s.select(*keys, at, seq, "frame", "data", F.lit(None).cast("binary").alias("info"))
    infos = packets.where(valid).select(*keys, F.col(at).alias("_at"), F.col(seq).alias("_seq"), F.col("data").alias("info"))
    placed = s.where("_place is not null").withColumns({"_at": F.col("_place.at"), "_seq": F.col("_place.seq")})
    return placed.join(infos, [*keys, "_at", "_seq"]).select(*keys, at, seq, "frame", "data", "info")


def _angles(info: np.ndarray, offset: int, count: int) -> np.ndarray | None:
    raw = info[offset : offset + 3 * count].reshape(-1, 3).astype(np.int64)
    if (raw[:, 0] == 0xFF).any():
        return None
    value = raw[:, 1] * 256 + raw[:, 2]
    return np.where(raw[:, 0] == 0, value, -value)


def decode_spinning(data: bytes, info: bytes, stamp_s: float, m: Spinning) -> np.ndarray:
    """(n, 6): x, y, z, intensity, ring, time of a packet's returns in range; empty without a valid calibration."""
    d, c = np.frombuffer(data, np.uint8), np.frombuffer(info, np.uint8)
    vert, horiz = _angles(c, m.vertical, m.channels), _angles(c, m.horizontal, m.channels)
    if vert is None or horiz is None:
        return np.zeros((0, 6))
    rpm = int(c[8]) * 256 + int(c[9])
    turn = round(36000 * (rpm / 60.0 if rpm else 10.0) * m.block_us * 1e-6)
    firing = np.array(m.firing_us)
    size = m.block_prefix + 3 * m.channels
    blocks = d[m.header : m.header + m.blocks * size].reshape(m.blocks, size)
    mark = np.frombuffer(m.block_mark, np.uint8)
    whole = np.cumprod((blocks[:, : len(mark)] == mark).all(1)).astype(bool)  # a bad mark ends the packet
    blocks = blocks[whole].astype(np.int64)
    chan = blocks[:, m.block_prefix :].reshape(len(blocks), m.channels, 3)
    dist = (chan[:, :, 0] * 256 + chan[:, :, 1]) * m.resolution
    start = blocks[:, m.block_prefix - 2] * 256 + blocks[:, m.block_prefix - 1]
    azimuth = start[:, None] + (turn * (firing / m.block_us)).astype(np.int64)
    final = azimuth + horiz
    if m.reversal is not None and c[m.reversal] != 0:
        azimuth, final = 36000 - azimuth, 36000 - final
    v = vert * UNIT
    x = dist * np.cos(v) * np.cos(final * UNIT) + m.lens[0] * np.cos(azimuth * UNIT)
    y = -dist * np.cos(v) * np.sin(final * UNIT) - m.lens[0] * np.sin(azimuth * UNIT)
    z = dist * np.sin(v) + m.lens[1]
    t = stamp_s + np.arange(len(blocks))[:, None] * m.block_us * 1e-6 + firing * 1e-6
    ring = np.broadcast_to((vert[None, :] < vert[:, None]).sum(1), x.shape)
    ok = (dist >= m.near) & (dist <= m.far)
    return np.stack([x, y, z, chan[:, :, 2], ring, t], axis=-1)[ok]


def decode_solid(data: bytes, stamp_s: float) -> np.ndarray:
    """(n, 6): x, y, z, intensity, ring, time of a packet's returns in range."""
    d = np.frombuffer(data, np.uint8)
    n, size = SOLID["blocks"], SOLID["block"]
    body = d[SOLID["header"] : SOLID["header"] + n * size].reshape(n, size).astype(np.int64)
    chan = body[:, 2:].reshape(n, SOLID["channels"], 9)

    def word(i: int) -> np.ndarray:
        return chan[:, :, i] * 256 + chan[:, :, i + 1]

    dist = word(0) * SOLID["resolution"]
    pitch, yaw = (word(2) - SOLID["zero"]) * UNIT, (word(4) - SOLID["zero"]) * UNIT
    x, y, z = dist * np.cos(pitch) * np.cos(yaw), dist * np.cos(pitch) * np.sin(yaw), dist * np.sin(pitch)
    t = np.broadcast_to(stamp_s + body[:, :1] * 1e-6, x.shape)
    ring = np.broadcast_to(np.arange(SOLID["channels"]), x.shape)
    ok = (dist >= SOLID["near"]) & (dist <= SOLID["far"])
    return np.stack([x, y, z, chan[:, :, 6], ring, t], axis=-1)[ok]


def decode_packets(sweeps: DataFrame, keys: list[str], at: str, seq: str, model: Spinning | None) -> DataFrame:
    """(keys, frame, at, seq, point_idx, x, y, z, intensity, ring, t) from numbered packets; no model = solid state.

    A dome packet of the newer hardware says so in its header and is read with that layout."""
    types = {f.name: f.dataType.simpleString() for f in sweeps.schema.fields}
    names = [*keys, "frame", at, seq]
    schema = ", ".join([f"`{k}` {types[k]}" for k in names] + ["point_idx int"] + [f"{c} float" for c in COLUMNS] + ["t double"])

    def points(row) -> np.ndarray:
        stamp = getattr(row, at) / 1e9
        if model is None:
            return decode_solid(row.data, stamp)
        newer = model is not None and model.data_id == DOME.data_id and row.data[31:33] == b"\x03\x04"
        return decode_spinning(row.data, row.info, stamp, DOME_NEW if newer else model)

    def table(rows: list, arrays: list[np.ndarray]) -> pd.DataFrame:
        pts = np.concatenate(arrays)
        counts = [len(a) for a in arrays]
        out = pd.DataFrame({k: np.repeat([getattr(r, k) for r in rows], counts) for k in names})
        out["point_idx"] = np.concatenate([np.arange(n, dtype="int32") for n in counts])
        for i, c in enumerate(COLUMNS):
            out[c] = pts[:, i].astype("float32")
        out["t"] = pts[:, 5]
        return out

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = list(pdf.itertuples(index=False))
            for k in range(0, len(rows), 64):  # some 25,000 points per output batch
                part = rows[k : k + 64]
                yield table(part, [points(r) for r in part])

    return sweeps.select(*names, "data", *(["info"] if model is not None else [])).mapInPandas(decode, schema)
