"""Point clouds: binary blobs of five float32 columns to rows and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

COLUMNS = ["x", "y", "z", "intensity", "ring"]


def explode_points(blobs: DataFrame, keys: list[str], content: str) -> DataFrame:
    """(keys, point_idx, x, y, z, intensity, ring) from binary columns of packed little-endian float32 rows."""
    types = {f.name: f.dataType.simpleString() for f in blobs.schema.fields}
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["point_idx int"] + [f"{c} float" for c in COLUMNS])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                pts = np.frombuffer(getattr(row, content), "<f4").reshape(-1, len(COLUMNS))
                out = pd.DataFrame(pts.astype("float32"), columns=COLUMNS)
                out.insert(0, "point_idx", np.arange(len(out), dtype="int32"))
                for i, k in enumerate(keys):
                    out.insert(i, k, [getattr(row, k)] * len(out))
                yield out

    return blobs.select(*keys, content).mapInPandas(unpack, schema)


def pack_points(points: DataFrame, frame: list[str], index: str) -> DataFrame:
    """(frame, n, content): the finite points of each frame as one blob, in index order. A frame is one sweep."""
    from trackloom.operators.grid import finite

    types = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    schema = ", ".join([f"`{k}` {types[k]}" for k in frame] + ["n int", "content binary"])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(index)[COLUMNS].to_numpy("<f4")
        head = {k: [pdf[k].iloc[0]] for k in frame}
        return pd.DataFrame({**head, "n": [len(rows)], "content": [rows.tobytes()]})

    good = finite(points.select(*frame, index, *COLUMNS), COLUMNS[:4])
    return good.groupBy(*frame).applyInPandas(pack, schema)
