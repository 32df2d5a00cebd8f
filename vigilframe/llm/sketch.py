"""Count-min sketches of 64-bit values, counted per partition and merged bin by bin."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from vigilframe.llm import tokens as T

BIN = 16  # bits of a cell's place in its bin


def cells(grams: np.ndarray, row: int, bits: int) -> np.ndarray:
    return T.mix(grams.view(T.U) ^ T.U(row * 0x5851F42D4C957F2D + 1)) >> T.U(64 - bits)


def partial_sketch(bits: int, depth: int):
    """The partition's sketch, as its touched cells: (bin, cells, counts up to 2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(depth)]
        pending = 0

        def packed():
            for row in range(depth):
                if not held[row]:
                    continue
                cell, count = np.unique(np.concatenate(held[row]), return_counts=True)
                held[row].clear()
                bins = (cell >> T.U(BIN)).astype(np.int64)
                border = np.flatnonzero(np.r_[True, np.diff(bins) != 0, True]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bins[border[:-1]] * depth + row),
                    pa.ListArray.from_arrays(border, pa.array((cell & T.U((1 << BIN) - 1)).astype(np.int32))),
                    pa.ListArray.from_arrays(border, pa.array(np.minimum(count, 2).astype(np.int8))),
                ], ["bin", "cells", "counts"])

        for batch in batches:
            grams = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            for row in range(depth):
                held[row].append(cells(grams, row, bits))
            pending += len(grams)
            if pending > 2_000_000:
                yield from packed()
                pending = 0
        yield from packed()
    return run


def merged_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the partitions' sketches per bin, as a bitmap of the cells that count 2 or more."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, cell, count in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            total = sums.setdefault(number, np.zeros(1 << BIN, np.uint8))
            places = cell.values.to_numpy()
            total[places] = np.minimum(total[places] + count.values.to_numpy(), 2)
    for number, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], ["bin", "repeated"])


def repeated_cells(values: DataFrame, total: int, depth: int, max_bits: int, prepare=iter) -> tuple[int, Broadcast]:
    """Bitmaps of the cells that count two or more, from one column of arrays (or what `prepare` makes of
    the batches); about eight cells a value.

    The driver holds `depth` bitmaps of at most `max_bits` bits, whatever the input.
    """
    bits = min(max(BIN + 2, int(8 * total).bit_length()), max_bits.bit_length() - 1)
    count = partial_sketch(bits, depth)
    merged = values.mapInArrow(lambda batches: count(prepare(batches)), "bin bigint, cells array<int>, counts array<tinyint>")
    bitmap = np.zeros((depth, 1 << (bits - BIN), 1 << (BIN - 3)), np.uint8)
    for x in merged.repartition("bin").mapInArrow(merged_sketch, "bin bigint, repeated binary").toLocalIterator():
        bitmap[x["bin"] % depth, x["bin"] // depth] = np.frombuffer(x["repeated"], np.uint8)
    return bits, values.sparkSession.sparkContext.broadcast(bitmap.reshape(depth, -1))


def estimated_repeated(values: np.ndarray, bitmaps: np.ndarray, bits: int) -> np.ndarray:
    """Mask of the values that may occur twice; a value that does is never left out."""
    keep = np.ones(len(values), bool)
    for row, bitmap in enumerate(bitmaps):
        cell = cells(values, row, bits)
        keep &= (bitmap[(cell >> T.U(3)).astype(np.int64)] >> (7 - (cell & T.U(7)).astype(np.uint8))) & 1 == 1
    return keep
