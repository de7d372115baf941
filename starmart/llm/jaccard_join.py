"""Exact Jaccard join of documents on word shingles, by T-occurrence search.

Two sets of sizes x and y whose similarity reaches s share at least s / (1 + s) * (x + y) elements. Shingles are ordered
from rare to common by the merged counts of a sketch; linked sets then share a shingle among the first ones of each, and
one that occurs in a single set cannot be shared. Sets that have such a shingle in common, directly or over others, are
searched together:

Their inverted lists are searched with DivideSkip. A query's lists are divided into the longest few and the rest; the
short lists are merged by sorting, which leaves the sets that occur often enough there, and these are looked up in the
long lists by binary search, all at once while they are many. Sets that reach the overlap are links.

The distance 1 - similarity is a metric, so not every pair has to be tried. Only pivots are indexed; a set that links with
a pivot becomes its member. A later set can link with a member only if it is near enough to the pivot, and it is compared
with members only while the two are not connected yet. A family of thousands of near copies thus needs one comparison for
each copy, and still no link between different sets that connects anything is missed.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .sketch import ASKED, Sketch
from .staging import block_of, carry_modules, parts, staged, text_bytes
from .words import flat, shingle_sets

SHINGLE, PERCENT = 5, 75
BLOCK_BYTES = 8 << 20
WORD_BYTES = 5
#: Shingles that are searched together in one task; a larger family is searched in pairs of slices of half as many.
TOGETHER = 1_000_000
#: Sets times shingles of a family that one task searches, as each set may meet the lists of all; beyond that slices are smaller.
SEARCHED = 1_000_000_000
#: Sets that are looked up one by one.
FEW = 12
#: DivideSkip's weight of the longest list when dividing.
MU = 0.01
SETS = "doc_id long, block int, node binary, n_shingles long, first array<bigint>"


def overlap_needed(x: int, y: int, percent: int = PERCENT) -> int:
    """Least number of shared elements of sets of sizes x and y whose similarity reaches the percentage."""
    return -(-percent * (x + y) // (100 + percent))


class Lists:
    """Inverted lists of sets, searched with DivideSkip."""

    def __init__(self) -> None:
        self.lists: dict[int, array] = {}

    def add(self, number: int, elements: list[int]) -> None:
        """Add a set; numbers must grow, so that lists stay sorted."""
        for e in elements:
            if (one := self.lists.get(e)) is None:
                self.lists[e] = one = array("i")
            one.append(number)

    def search(self, elements: list[int], least: int) -> dict[int, int]:
        """Sets that share at least `least` elements with the query, and how many."""
        found = [x for x in map(self.lists.get, elements) if x is not None]
        if len(found) < least:
            return {}
        found.sort(key=len, reverse=True)
        long = min(least - 1, int(least / (MU * math.log2(max(2, len(found[0]))) + 1)))
        # a set that reaches `least` is at least so often in the lists that are not long
        often = least - long
        merged = np.sort(np.concatenate([np.frombuffer(x, np.int32) for x in found[long:]]))
        bounds = np.append(np.flatnonzero(np.diff(merged, prepend=-1)), len(merged))
        numbers, times = merged[bounds[:-1]], np.diff(bounds)
        enough = times >= often
        numbers, times = numbers[enough], times[enough]
        for i, one in enumerate(found[:long]):
            hopeful = times + (long - i) >= least
            numbers, times = numbers[hopeful], times[hopeful]
            if len(numbers) <= FEW:
                return self._looked_up(found[i:long], numbers.tolist(), times.tolist(), least)
            held = np.frombuffer(one, np.int32)
            times = times + (held[np.minimum(np.searchsorted(held, numbers), len(held) - 1)] == numbers)
        reached = times >= least
        return dict(zip(numbers[reached].tolist(), times[reached].tolist(), strict=True))

    @staticmethod
    def _looked_up(long: list[array], numbers: list[int], counts: list[int], least: int) -> dict[int, int]:
        """The few sets that are left, one by one in the long lists that are left."""
        out = {}
        for number, times in zip(numbers, counts, strict=True):
            for i, one in enumerate(long):
                if times + len(long) - i < least:
                    break
                at = bisect_left(one, number)
                times += at < len(one) and one[at] == number
            if times >= least:
                out[number] = times
        return out


def links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of linked sets, enough to connect all that links connect. Sets are sorted and not empty."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sets = [sets[k] for k in order]  # numbers below are places in this order, in which lists grow
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out: list[tuple[int, int]] = []

    def connect(i: int, j: int) -> None:
        if root(i) != root(j):
            out.append((order[i], order[j]))
            parent[root(i)] = root(j)

    pivots = Lists()
    members: dict[int, list[int]] = {}
    radius: dict[int, float] = {}
    reach = 1 - percent / 100
    for i, each in enumerate(sets):
        own, n = each.tolist(), len(each)
        # a member of a pivot lies at most `reach` from it, so the pivot of a set's link lies at most twice as far
        far = max(1, math.ceil(n * max(0.0, 1 - 2 * reach) - 1e-9))
        near = []
        for p, shared in pivots.search(own, far).items():
            distance = 1 - shared / (n + len(sets[p]) - shared)
            near.append((distance, p, shared))
        near.sort()
        home = None
        for distance, p, shared in near:
            if shared >= overlap_needed(n, len(sets[p]), percent):
                connect(i, p)
                if home is None:
                    home = p
                    members[p].append(i)
                    radius[p] = max(radius[p], distance)
        for distance, p, _ in near:
            if distance <= reach + radius[p] + 1e-9 and root(p) != root(i):
                for m in members[p]:
                    shared = len(np.intersect1d(sets[m], sets[i], assume_unique=True))
                    if shared >= overlap_needed(n, len(sets[m]), percent):
                        connect(i, m)
                        break
        if home is None:
            pivots.add(i, own)
            members[i], radius[i] = [], 0.0
    return out


def _node(shingles: np.ndarray) -> bytes | None:
    return hashlib.md5(shingles.tobytes()).digest() if len(shingles) else None


def document_sets(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES):
    """The documents dealt into blocks, and for every row its set's size, digest and those first shingles that others have.

    Returns (dealt documents, sets); sets are a written table: doc_id, block, node (NULL without words), n_shingles, first.
    """
    carry_modules(docs.sparkSession)
    total = text_bytes(docs)
    blocks = parts(total, block_bytes)
    sketch = Sketch.for_hashes(total // WORD_BYTES)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", block_of(blocks, "doc_id", "text").alias("block"))
    grouped = dealt.groupBy("block")

    def different(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        sets = shingle_sets(flat(table["text"]), shingle, True)
        once = list({_node(s): s for s in sets}.values())
        hashes, counts = np.unique(np.concatenate(once) if once else np.zeros(0, np.uint64), return_counts=True)
        return sets, hashes, counts

    def count(table: pa.Table) -> pa.Table:
        _, hashes, counts = different(table)
        return sketch.ask(table["block"][0].as_py(), hashes, counts)

    def first_ones(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets, hashes, _ = different(table)
        times = sketch.estimates(hashes, answers)
        out = []
        for s in sets:
            n = len(s)
            t = times[np.searchsorted(hashes, s)]
            order = np.lexsort((s, t))[: n - -(-percent * n // 100) + 1]
            out.append(s[order][t[order] > 1].view(np.int64))
        return pa.Table.from_arrays([
            table["doc_id"].combine_chunks(), table["block"].combine_chunks(), pa.array(map(_node, sets), pa.binary()),
            pa.array(map(len, sets), pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "block", "node", "n_shingles", "first"])

    answers = sketch.answers(grouped.applyInArrow(count, ASKED))
    sets = grouped.cogroup(answers.groupBy("block")).applyInArrow(first_ones, SETS)
    return dealt, staged(sets, "shingle-sets")


def _searched(dealt: DataFrame, chosen: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) among the chosen documents: doc_id, block, node, task and slice; one row for each task of a document."""
    def pick(table: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = {}
        for w in wanted.to_pylist():
            rows.setdefault(w["doc_id"], []).append(w)
        texts = flat(table["text"])
        ids, nodes = table["doc_id"].to_pylist(), [None] * len(table)
        hit = [i for i, d in enumerate(ids) if d in rows]
        for i, s in zip(hit, shingle_sets(texts.take(pa.array(hit, pa.int64())), shingle, True), strict=True):
            nodes[i] = (_node(s), s)
        out, used = [], set()
        for i in hit:
            for w in rows[ids[i]]:
                # of rows that share an id only the one with the wanted set counts
                if nodes[i][0] == w["node"] and (w["task"], w["node"]) not in used:
                    used.add((w["task"], w["node"]))
                    out.append({"task": w["task"], "doc_id": ids[i], "n": len(nodes[i][1]), "shingles": nodes[i][1].tobytes()})
        return pa.Table.from_pylist(out, pa.schema([("task", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())]))

    def search(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["doc_id"].to_pylist(), table["shingles"].to_pylist(), strict=True))
        found = links([np.frombuffer(s, np.uint64) for _, s in rows], percent)
        return pa.Table.from_arrays([pa.array([rows[i][0] for i, _ in found], pa.int64()), pa.array([rows[j][0] for _, j in found], pa.int64())], names=["a", "b"])

    texts = dealt.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(pick, "task string, doc_id long, n long, shingles binary")
    return texts.groupBy("task").applyInArrow(lambda table: search(table), "a long, b long")


def jaccard_components(
    docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES, together: int = TOGETHER,
    searched: int = SEARCHED,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Words are lower-cased by A to Z; a text of fewer than `shingle` words is one shingle. Documents link when their sets'
    similarity reaches `percent`; component_id is the smallest id that links reach, the document's own included. A text
    that is NULL or without words has no set and links with nothing. A row with a NULL id has a component of NULL and
    links with nothing. Rows that share an id stand for one document only if their texts do; other columns are left out.
    """
    dealt, sets = document_sets(docs, shingle=shingle, percent=percent, block_bytes=block_bytes)
    named = sets.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    # equal sets are one from here on, known by the smallest document that has it
    nodes = staged(named.groupBy("node").agg(
        F.min(F.struct("doc_id", "block")).alias("r"), F.first("n_shingles").alias("n"), F.first("first").alias("first"),
    ).select("node", F.col("r.doc_id").alias("doc_id"), F.col("r.block").alias("block"), "n", "first"), "distinct-sets")
    postings = nodes.select("doc_id", F.explode("first").alias("shingle"))
    roots = postings.groupBy("shingle").agg(F.min("doc_id").alias("root"), F.count("*").alias("held")).where("held > 1")
    near = components(postings.join(roots, "shingle").where("doc_id <> root").select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    near = staged(near, "near")
    family = near.join(nodes, near["node"] == nodes["doc_id"]).select("component", nodes["node"], "doc_id", "block", "n")
    sizes = staged(family.groupBy("component").agg(F.sum("n").alias("size"), F.count("*").alias("held")), "family-sizes")
    tasks = parts(sizes.agg(F.sum("size").alias("s")).first()["s"] or 0, together)
    # two slices of a family of which each is 1 / slices hold 2 / slices of its sets and of its shingles
    work = F.col("held").cast("double") * F.col("size")
    slices = F.when((F.col("size") <= together) & (work <= searched), 1).otherwise(
        F.greatest(F.ceil(F.col("size") * 2 / together), F.ceil(F.sqrt(work / searched) * 2))).cast("int")
    placed = family.join(sizes, "component").withColumn("slices", slices).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    task = F.when(F.col("slices") == 1, F.pmod(F.xxhash64("component"), F.lit(tasks)).cast("string")).otherwise(
        F.concat_ws(":", "component", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string")))
    chosen = placed.withColumn("other", other).select("doc_id", "block", "node", task.alias("task"))
    found = components(_searched(dealt, chosen, shingle, percent))
    classes = staged(nodes.join(found, nodes["doc_id"] == found["node"]).select(nodes["node"], "component"), "classes")
    whole = nodes.select("node", F.col("doc_id").alias("least")).join(classes, "node", "left")
    # copies of one text share a node: it is looked up once for each block that holds some, and then by block
    placed = sets.select("node", "block").distinct().join(whole, "node")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "least", "doc_id"))
    return sets.join(placed, ["node", "block"], "left").select("doc_id", "n_shingles", component.alias("component_id"))
