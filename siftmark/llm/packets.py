"""Compressed packets of number columns, dealt to partitions by a part number.

An operator that sends a number for nearly every word of the corpus would pay more for row overhead
than for the numbers. A map task instead gathers, per part, plain number columns and compresses them;
Spark shuffles the packets by their part like any other row, and a reduce function gets all of a part.
Parts are as many as shuffle partitions, so they grow in number and not in size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

#: Rows gathered before a map task writes packets: bounds its memory.
PACKET_ROWS = 2_000_000


def part_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(columns: dict[str, np.ndarray], parts: np.ndarray, count: int) -> Iterator[pa.RecordBatch]:
    """One packet row for each part that has rows."""
    order = np.argsort(parts, kind="stable")
    edges = np.searchsorted(parts[order], np.arange(count + 1))
    sorted_columns = {k: np.ascontiguousarray(v[order]) for k, v in columns.items()}
    press = zstandard.ZstdCompressor(level=1)
    used = np.flatnonzero(np.diff(edges))
    out: dict[str, list] = {k: [] for k in columns}
    for p in used:
        for k, v in sorted_columns.items():
            out[k].append(press.compress(v[edges[p] : edges[p + 1]].tobytes()))
    if len(used):
        yield pa.record_batch({"part": pa.array(used, pa.int32()), **{k: pa.array(v, pa.binary()) for k, v in out.items()}})


def unpack(table: pa.Table, kinds: dict[str, np.dtype]) -> dict[str, np.ndarray]:
    """The number columns of all packets of a part."""
    press = zstandard.ZstdDecompressor()
    out = {}
    for name, kind in kinds.items():
        pieces = [np.frombuffer(press.decompress(x), kind) for x in table[name].to_pylist()]
        out[name] = np.concatenate(pieces) if pieces else np.zeros(0, kind)
    return out


def schema(kinds: dict[str, np.dtype]) -> str:
    return "part int, " + ", ".join(f"{k} binary" for k in kinds)


class Gather:
    """Number columns gathered over batches and written as packets once there are many."""

    def __init__(self, kinds: dict[str, np.dtype], count: int):
        self.kinds, self.count, self.rows = kinds, count, 0
        self.pieces: dict[str, list[np.ndarray]] = {k: [] for k in ("part", *kinds)}

    def add(self, parts: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.rows += len(parts)
        self.pieces["part"].append(parts.astype(np.int32))
        for k, kind in self.kinds.items():
            self.pieces[k].append(columns[k].astype(kind, copy=False))
        if self.rows >= PACKET_ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            whole = {k: np.concatenate(v) for k, v in self.pieces.items()}
            yield from pack({k: whole[k] for k in self.kinds}, whole["part"], self.count)
        self.rows, self.pieces = 0, {k: [] for k in self.pieces}


def reduce_parts(packets: DataFrame, kinds: dict[str, np.dtype],
                 run: Callable[[dict[str, np.ndarray]], Iterator[pa.RecordBatch]], out_schema: str,
                 empty: Callable[[], pa.Table]) -> DataFrame:
    """The packets of each part, unpacked together and handed to the function."""
    def group(table: pa.Table) -> pa.Table:
        batches = list(run(unpack(table, kinds)))
        return pa.Table.from_batches(batches) if batches else empty()

    return packets.groupBy("part").applyInArrow(group, out_schema)


def empty_packets(kinds: dict[str, np.dtype]) -> pa.Table:
    return pa.table({"part": pa.array([], pa.int32()), **{k: pa.array([], pa.binary()) for k in kinds}})
