"""A count-min sketch over blocks of documents, kept in shards.

Each block of documents counts its own hashes and sends, for every row of the sketch, its cells and their counts to the
shards that hold these cells. A shard merges the partition sketches by addition and answers each block with the merged
counts of the cells that the block has asked for. So nobody ever holds the whole sketch, which grows with the data: a block
learns an estimate for each of its own hashes, never below the true count, and a shard holds a fixed range of cells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .words import mix

#: Rows of the sketch, and cells of a row for each hash that is expected.
DEPTH, CELLS_PER_HASH = 2, 4
#: Cells that one shard holds, one byte each.
SHARD_CELLS = 1 << 24
ASKED = "shard int, block int, n int, cells binary, counts binary"
ANSWERED = "block int, shard int, n int, counts binary"
_ASKED = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])
_ANSWERED = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("counts", pa.binary())])


def packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes, the first bytes of all values first."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    """The array that :func:`packed` has written."""
    kind = np.dtype(kind)
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, n * kind.itemsize))
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(n)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of an increasing array, the first from 0."""
    return np.diff(values, prepend=values.dtype.type(0))


def runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if not len(values):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


@dataclass(frozen=True)
class Sketch:
    """Shape of a sketch whose counts stop at `most`."""

    bits: int  # a row has 2 ** bits cells
    most: int = 255
    depth: int = DEPTH

    @classmethod
    def for_hashes(cls, n: int, most: int = 255) -> Sketch:
        return cls(max(10, int(np.ceil(np.log2(max(1, n) * CELLS_PER_HASH)))), most)

    @property
    def shard_cells(self) -> int:
        return min(SHARD_CELLS, max(1 << 10, (self.depth << self.bits) // 16))

    def _cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        salt = np.uint64((0x9E3779B97F4A7C15 * (2 * row + 1)) & (2**64 - 1))
        return (mix(hashes ^ salt) >> np.uint64(64 - self.bits)) + np.uint64(row << self.bits)

    def ask(self, block: int, hashes: np.ndarray, counts: np.ndarray) -> pa.Table:
        """What a block sends for its distinct hashes."""
        out = []
        for row in range(self.depth):
            cells, where = np.unique(self._cells(hashes, row), return_inverse=True)
            held = np.minimum(np.bincount(where, counts, len(cells)), self.most).astype(np.uint8)
            out += self._messages(block, cells, held)
        return pa.Table.from_pylist(out, _ASKED)

    def _messages(self, block: int, cells: np.ndarray, held: np.ndarray) -> list[dict]:
        width = np.uint64(self.shard_cells)
        shards = cells // width
        out = []
        for a, b in runs_of(shards):
            inside = (cells[a:b] % width).astype(np.uint32)
            out.append({"shard": int(shards[a]), "block": block, "n": b - a, "cells": packed(steps(inside)), "counts": packed(held[a:b])})
        return out

    def merge(self, table: pa.Table) -> pa.Table:
        """A shard: add up what all blocks have sent, and answer each with the sums of its cells."""
        total = np.zeros(self.shard_cells, np.uint8)
        rows = table.to_pylist()
        for r in rows:
            cells = np.cumsum(unpacked(r["cells"], r["n"], np.uint32), dtype=np.uint32)
            more = unpacked(r["counts"], r["n"], np.uint8).astype(np.uint16)
            total[cells] = np.minimum(total[cells] + more, self.most)
        out = [{"block": r["block"], "shard": r["shard"], "n": r["n"], "counts": packed(
            total[np.cumsum(unpacked(r["cells"], r["n"], np.uint32), dtype=np.uint32)])} for r in rows]
        return pa.Table.from_pylist(out, _ANSWERED)

    def answers(self, asked: DataFrame) -> DataFrame:
        merge = self.merge
        return asked.groupBy("shard").applyInArrow(lambda table: merge(table), ANSWERED)

    def estimates(self, hashes: np.ndarray, answers: pa.Table) -> np.ndarray:
        """The merged counts of a block's distinct hashes: the least over the rows."""
        # a shard lies in one row, as its cells divide a row's
        order = sorted(answers.to_pylist(), key=lambda r: r["shard"])
        if not len(hashes):
            return np.zeros(0, np.uint8)
        by_row = [[] for _ in range(self.depth)]
        whole = [np.unique(self._cells(hashes, row), return_inverse=True) for row in range(self.depth)]
        for r in order:
            row = min(self.depth - 1, (r["shard"] * self.shard_cells) >> self.bits)
            by_row[row].append(unpacked(r["counts"], r["n"], np.uint8))
        out = np.full(len(hashes), 255, np.uint8)
        for (cells, where), parts in zip(whole, by_row, strict=True):
            counts = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            assert len(counts) == len(cells), "answers do not fit what was asked"
            out = np.minimum(out, counts[where])
        return out
