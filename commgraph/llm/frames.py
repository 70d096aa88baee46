"""Small helpers for Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame(**columns) -> pd.DataFrame:
    """A pandas frame whose strings and bytes are plain objects, which convert
    to one Arrow array however they were made."""
    out = {}
    for name, values in columns.items():
        if isinstance(values, list) and (not values or isinstance(values[0], str | bytes | list | type(None))):
            values = pd.Series(values, dtype=object)
        out[name] = values
    return pd.DataFrame(out)


def rows_frame(rows: list[tuple], *names: str) -> pd.DataFrame:
    return frame(**{n: list(c) for n, c in zip(names, zip(*rows) if rows else [[] for _ in names])})


def grouped_stream(df: DataFrame, fn: Callable, schema: str, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Grouped map with bounded memory: rows are brought together by ``keys``
    and sorted, and ``fn(key, frames)`` is given each key's rows batch by batch."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, []
        for b in batches:
            for key, g in b.groupby(list(keys), sort=False, dropna=False):
                if current is not None and key != current:
                    yield from fn(current, held)
                    held = []
                current = key
                held.append(g)
        if current is not None:
            yield from fn(current, held)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(stream, schema)


def hash_sample(rows: DataFrame, text: str, n: int) -> list[str]:
    """The distinct texts with the ``n`` least hashes, the same ones however the
    rows are laid out. Tasks send hashes first, and texts only below the limit
    those set, so the driver gets little more than the sample at any size."""
    h = F.xxhash64(text)
    own = rows.select(F.col(text)).where(F.col(text).isNotNull())
    least = [r["h"] for r in own.select(h.alias("h")).distinct().orderBy("h").limit(n).collect()]  # bounded by n
    if not least:
        return []
    return sorted(r[text] for r in own.where(h <= F.lit(least[-1])).distinct().collect())  # bounded by n


def packed(**columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    """One row, which holds each of the arrays as bytes, so that the JVM passes them on as they are; Arrow arrays are columns."""
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array([x.tobytes()], pa.binary()) for x in columns.values()], list(columns))


def unpacked(row: pa.RecordBatch, column: str, kind: type) -> np.ndarray:
    own = row.column(column)[0].as_buffer()
    return np.frombuffer(own, kind) if own.size else np.empty(0, kind)


#: Cells of sums that go in one row.
BLOCK = 1 << 14
SUMS = "kind int, block int, at binary, first binary, second binary"


def added(rows: DataFrame, sums: Callable[[Iterator[pa.RecordBatch]], list[np.ndarray]], sizes: list[int]) -> list[np.ndarray]:
    """The arrays (2, size) that ``sums`` makes of each partition, added up. They go in
    blocks, and tasks add them up by block; the driver gets each cell once."""

    def row(kind: int, block: int, x: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(x.any(0))
        return packed(kind=pa.array([kind], pa.int32()), block=pa.array([block], pa.int32()), at=at.astype(np.uint16), first=x[0, at], second=x[1, at])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, x in enumerate(sums(batches)):
            for k in range(0, x.shape[1], BLOCK):
                if x[:, k : k + BLOCK].any():
                    yield row(kind, k // BLOCK, x[:, k : k + BLOCK])

    def join(total: np.ndarray, at: bytes, first: bytes, second: bytes) -> None:
        own = np.frombuffer(at, np.uint16)
        total[0, own] += np.frombuffer(first)
        total[1, own] += np.frombuffer(second)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for r in (r for b in batches for r in b.to_pylist()):
            join(held.setdefault((r["kind"], r["block"]), np.zeros((2, BLOCK))), r["at"], r["first"], r["second"])
        for (kind, block), x in held.items():
            yield row(kind, block, x)

    out = [np.zeros((2, n)) for n in sizes]
    for kind, block, *sent in rows.mapInArrow(part, SUMS).repartition("kind", "block").mapInArrow(whole, SUMS).collect():  # bounded by sizes
        join(out[kind][:, block * BLOCK : (block + 1) * BLOCK], *sent)
    return out
