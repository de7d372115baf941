"""Removal of repeated passages: every word that lies in a window of words found earlier in the corpus.

A count-min sketch of all windows, merged from the sketches of the blocks of documents, tells which windows may occur more
than once; it overestimates, so no repeated window is missed. Only these are then grouped exactly, by a 96-bit digest of
their words, to find the earliest document that has each. A block sends each of its windows once, however often it holds
it, so a passage that a third of all documents share costs a shard one entry for each block.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sketch import Sketch, packed, runs_of, steps, unpacked
from .staging import block_of, carry_modules, parts, text_bytes
from .words import SECOND_BASE, Words, flat, slices

WINDOW = 20
#: UTF-8 bytes of text in a block. A task needs some 30 times as much memory; larger blocks send fewer, longer messages.
BLOCK_BYTES = 4 << 20
#: UTF-8 bytes that a word takes at least on average; only the size of the sketch rests on it.
WORD_BYTES = 5
CANDIDATES = "shard int, block int, n int, keys binary, checks binary, docs binary"
FLAGGED = "block int, n int, keys binary"
_CANDIDATES = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("checks", pa.binary()), ("docs", pa.binary())])
_FLAGGED = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary())])
_LEAST = -(1 << 63)


class _Block:
    """The windows of a block's documents, in the order of the documents and of the words."""

    def __init__(self, table: pa.Table, length: int):
        self.block = table["block"][0].as_py() if len(table) else 0
        ids = table["doc_id"].fill_null(_LEAST).to_numpy()
        digests = np.array([hashlib.sha1((t.as_py() or "").encode()).hexdigest() for t in table["text"]], "U40")
        order = np.lexsort((digests, ids))
        self.table, self.docs = table.take(order), ids[order]
        column = flat(self.table["text"])
        keys, checks, starts, counts, words = [], [], [], [], 0
        for low, high in slices(column):
            w = Words(column[low:high])
            at = w.run_starts(length)
            keys.append(w.runs(at, length))
            checks.append(w.runs(at, length, SECOND_BASE).astype(np.uint32))
            starts.append(at + words)
            counts.append(w.count)
            words += len(w.hashes)
        join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
        self.keys, self.checks = join(keys, np.uint64), join(checks, np.uint32)
        self.starts, self.counts, self.words = join(starts, np.int64), join(counts, np.int64), words
        self.word_ends = np.cumsum(self.counts)
        # distinct windows, the first place of each, and which of them each window is
        self.distinct, self.first, self.which, self.times = np.unique(self.keys, return_index=True, return_inverse=True, return_counts=True)


def _owners(table: pa.Table) -> pa.Table:
    """A shard: of each window the earliest document keeps it; every other block is told the key."""
    rows = table.to_pylist()
    keys = np.concatenate([np.cumsum(unpacked(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
    checks = np.concatenate([unpacked(r["checks"], r["n"], np.uint32) for r in rows])
    docs = np.concatenate([unpacked(r["docs"], r["n"], np.int64) for r in rows])
    sender = np.repeat(np.arange(len(rows)), [r["n"] for r in rows])
    blocks = np.array([r["block"] for r in rows])
    order = np.lexsort((blocks[sender], docs, checks, keys))
    k, c = keys[order], checks[order]
    later = np.zeros(len(order), bool)
    later[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    flagged = np.zeros(len(order), bool)
    flagged[order] = later
    out, low = [], 0
    for r in rows:
        own = keys[low: low + r["n"]][flagged[low: low + r["n"]]]
        low += r["n"]
        if len(own):
            out.append({"block": r["block"], "n": len(own), "keys": packed(steps(own))})
    return pa.Table.from_pylist(out, _FLAGGED)


def remove_repeats(docs: DataFrame, length: int = WINDOW, *, with_text: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words joined by one space, for every row.

    A word goes if a window of `length` words that covers it starts with the same words earlier: in a document of smaller
    id, or further up in the same one. NULL ids come before all others. Of rows with one id the order is that of a digest
    of their texts; a row that repeats wholly is a copy. A NULL text has no words. Other columns are left out.

    Documents are dealt into blocks once; all passes read that one exchange.
    """
    carry_modules(docs.sparkSession)
    total = text_bytes(docs)
    blocks = parts(total, block_bytes)
    sketch = Sketch.for_hashes(total // WORD_BYTES, 2)
    shards = max(1, blocks)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", block_of(blocks, "doc_id", "text").alias("block")).groupBy("block")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")

    def count(table: pa.Table) -> pa.Table:
        b = _Block(table, length)
        return sketch.ask(b.block, b.distinct, b.times)

    def candidates(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return _CANDIDATES.empty_table()
        b = _Block(table, length)
        again = sketch.estimates(b.distinct, answers) > 1
        keys, first = b.distinct[again], b.first[again]
        target = (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
        out = []
        for a, z in runs_of(target):
            at = first[a:z]
            out.append({"shard": int(target[a]), "block": b.block, "n": z - a, "keys": packed(steps(keys[a:z])),
                        "checks": packed(b.checks[at]), "docs": packed(b.docs[np.searchsorted(b.word_ends, b.starts[at], "right")])})
        return pa.Table.from_pylist(out, _CANDIDATES)

    def clean(table: pa.Table, flagged: pa.Table) -> pa.Table:
        b = _Block(table, length)
        known = [np.cumsum(unpacked(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in flagged.to_pylist()]
        elsewhere = np.isin(b.distinct, np.concatenate(known)) if known else np.zeros(len(b.distinct), bool)
        repeated = elsewhere[b.which] | (b.first[b.which] != np.arange(len(b.which)))
        starts = b.starts[repeated]
        change = np.zeros(b.words + 1, np.int32)
        change[starts] += 1
        change[starts + length] -= 1
        kept = np.cumsum(change)[:-1] == 0
        low, removed, digests, texts = 0, [], [], []
        for text, n in zip(b.table["text"], b.counts.tolist(), strict=True):
            mine = kept[low: low + n]
            low += n
            words = (text.as_py() or "").encode().split()
            gone = n - int(mine.sum())
            line = b" ".join(compress(words, mine) if gone else words)
            removed.append(gone)
            digests.append(hashlib.sha256(line).hexdigest())
            if with_text:
                texts.append(line.decode())
        columns = [pa.array(b.docs, pa.int64(), mask=b.docs == _LEAST), pa.array(b.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns.append(pa.array(texts, pa.string()))
            names.append("text")
        return pa.Table.from_arrays(columns, names)

    answers = sketch.answers(dealt.applyInArrow(count, "shard int, block int, n int, cells binary, counts binary"))
    asked = dealt.cogroup(answers.groupBy("block")).applyInArrow(candidates, CANDIDATES)
    flagged = asked.groupBy("shard").applyInArrow(lambda table: _owners(table), FLAGGED)
    return dealt.cogroup(flagged.groupBy("block")).applyInArrow(clean, schema)
