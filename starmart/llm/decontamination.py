"""Benchmark passages in documents, found by fingerprints of item-sized windows.

Every benchmark item is compared with the windows of its own length in every document. Window and item are bags of word
shingles; each gets a 64-bit SimHash, in which every shingle weighs as often as it occurs. Fingerprints are indexed by
eight blocks of eight bits: two that differ in at most `radius` bits differ in at most radius // 8 bits in some block, so
looking up all block values that near finds every fingerprint within the radius. What is found is compared exactly, by the
weighted similarity of the two bags.

A window that shares less than the overlap which the similarity implies with all items of its length cannot reach it, and
gets no fingerprint; this bound loses nothing. Documents are read once and not shuffled. The benchmark is taken in parts
of bounded size, each sent to all executors and passed over all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import carry_modules
from .words import Words, flat, slices

SHINGLE, PERCENT = 5, 75
#: Bits in which the fingerprints of a window and an item may differ. At a similarity of 0.75 about 11 of 64 differ, give
#: or take 3; this is four deviations more.
RADIUS = 23
#: Items and UTF-8 bytes of a part of the benchmark.
PART_ITEMS, PART_BYTES = 4096, 8 << 20
BLOCKS, BLOCK_BITS = 8, 8
LEAKS = "doc_id long, item_id long, similarity double, first_word long, n_words long"
_BIT_COUNTS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def simhash(shingles: np.ndarray) -> np.uint64:
    """Fingerprint of a bag of shingle hashes: each bit is the majority of the shingles' bits."""
    bits = np.unpackbits(np.ascontiguousarray(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(shingles)).view(np.uint64)[0]


def weighted_similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Sum of the lesser and of the greater weights."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low, sum(a.values()) + sum(b.values()) - low


@dataclass
class _Class:
    """Items of one length in words."""

    length: int
    shingle: int
    items: list[int] = field(default_factory=list)
    bags: list[Counter] = field(default_factory=list)
    prints: list[np.uint64] = field(default_factory=list)

    def close(self, radius: int) -> None:
        self.known = np.unique(np.array([s for b in self.bags for s in b], np.uint64))
        self.fingerprints = np.array(self.prints, np.uint64)
        blocks = self.fingerprints.view(np.uint8).reshape(-1, BLOCKS)
        values = np.arange(256, dtype=np.uint8)
        # items whose block lies near enough to a value: one table for each block
        self.near = [_BIT_COUNTS[values[:, None] ^ blocks[None, :, b]] <= radius // BLOCKS for b in range(BLOCKS)]

    def candidates(self, fingerprint: np.uint64, radius: int) -> np.ndarray:
        parts = np.array([fingerprint], np.uint64).view(np.uint8)
        some = reduce(np.logical_or, (self.near[b][parts[b]] for b in range(BLOCKS)))
        at = np.flatnonzero(some)
        differing = _BIT_COUNTS[(self.fingerprints[at] ^ fingerprint).view(np.uint8).reshape(-1, 8)].sum(1)
        return at[differing <= radius]


class Index:
    """A part of the benchmark, by item length."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, percent: int, radius: int):
        self.percent, self.radius, self.shingle = percent, radius, shingle
        self.classes: dict[int, _Class] = {}
        for item, text in items:
            w = Words(pa.array([text or ""]), True)
            n = len(w.hashes)
            if n:
                k = min(shingle, n)
                c = self.classes.setdefault(n, _Class(n, k))
                hashes = w.runs(np.arange(n - k + 1), k)
                c.items.append(item)
                c.bags.append(Counter(hashes.tolist()))
                c.prints.append(simhash(hashes))
        for c in self.classes.values():
            c.close(radius)
        # by shingle size: all shingles of its classes, and a table of their leading bits that spares most look-ups
        self.sizes = {}
        for k in {c.shingle for c in self.classes.values()}:
            known = np.unique(np.concatenate([c.known for c in self.classes.values() if c.shingle == k]))
            table = np.zeros(1 << 20, bool)
            table[known >> np.uint64(44)] = True
            self.sizes[k] = (known, table)

    def leaks(self, column: pa.Array) -> list[list[tuple]]:
        """For each text: (item, similarity, first word, words) of the best window of each item that leaks."""
        out: list[list[tuple]] = [[] for _ in range(len(column))]
        for low, high in slices(column):
            words = Words(column[low:high], True)
            for k, (known, table) in self.sizes.items():
                starts = words.run_starts(k)
                hashes = words.runs(starts, k)
                maybe = np.flatnonzero(table[hashes >> np.uint64(44)])
                hits = maybe[np.isin(hashes[maybe], known)]
                if not len(hits):
                    continue
                bounds = np.searchsorted(starts, words.first)
                rows = np.searchsorted(bounds, hits, "right") - 1
                for row in np.unique(rows):
                    a, b = bounds[row], bounds[row + 1]
                    out[low + row] += self._document(hashes[a:b], hits[rows == row] - a, k)
        return out

    def _document(self, hashes: np.ndarray, hits: np.ndarray, k: int) -> list[tuple]:
        n, best = len(hashes), {}
        for c in self.classes.values():
            own = hits[np.isin(hashes[hits], c.known)] if c.shingle == k else hits[:0]
            if not len(own):
                continue
            size = c.length - k + 1  # shingles of an item; a window of a shorter document has all it has
            wide = min(size, n)
            # least weight in common that a window of `wide` shingles needs
            need = -(-self.percent * (size + wide) // (100 + self.percent))
            if len(own) < need:
                continue
            # windows that start so that they can hold `need` hits
            there = np.zeros(n + 1, np.int32)
            there[own + 1] = 1
            sums = np.cumsum(there)
            first = np.unique((own[:, None] - np.arange(wide)[None, :]).ravel())
            first = first[(first >= 0) & (first + wide <= n)]
            first = first[sums[first + wide] - sums[first] >= need]
            for start in first.tolist():
                window = hashes[start: start + wide]
                bag = None
                for i in c.candidates(simhash(window), self.radius).tolist():
                    bag = bag or Counter(window.tolist())
                    low, high = weighted_similarity(bag, c.bags[i])
                    if 100 * low >= self.percent * high:
                        found = (-low / high, start, wide + k - 1)
                        if c.items[i] not in best or found < best[c.items[i]]:
                            best[c.items[i]] = found
        return [(item, -s, start, n_words) for item, (s, start, n_words) in best.items()]


def _parts(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, in lists of bounded size; the driver holds one list at a time."""
    held, size = [], 0
    for r in benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").toLocalIterator():
        held.append((r[0], r[1]))
        size += len(r[1].encode())
        if len(held) >= PART_ITEMS or size >= PART_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): of each document and item the best window that reaches `percent`.

    Words are lower-cased by A to Z. An item of fewer than `shingle` words is one shingle of its own; items without words
    and NULL texts match nothing. A document shorter than an item is compared whole. Rows are taken one by one, so
    repeated rows repeat their leaks. Of equal windows the first counts. Other columns are left out.
    """
    carry_modules(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for items in _parts(benchmark):
        sent = spark.sparkContext.broadcast(items)  # at most PART_BYTES and one item

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, shingle, percent, radius)
            for batch in batches:
                leaks = index.leaks(flat(batch.column(1)))
                at = [i for i, own in enumerate(leaks) for _ in own]
                columns = list(zip(*(x for own in leaks for x in own), strict=True)) or [[], [], [], []]
                picked = pa.array(at, pa.int64())
                kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                    names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        part = rows.mapInArrow(run, LEAKS)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], LEAKS) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` in which no item leaks, all their columns unchanged, in one pass for each part of the benchmark."""
    carry_modules(docs.sparkSession)
    shingle, percent, radius = (options.get(k, v) for k, v in (("shingle", SHINGLE), ("percent", PERCENT), ("radius", RADIUS)))
    spark = docs.sparkSession
    for items in _parts(benchmark):
        sent = spark.sparkContext.broadcast(items)
        place = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], sent=sent, place=place) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, shingle, percent, radius)
            for batch in batches:
                clean = [not own for own in index.leaks(flat(batch.column(place)))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
