"""Order-preserving packing of token streams into windows, by dynamic programming.

The documents of a partition form one stream of tokens in their order. The stream is cut into windows of at most
`capacity` tokens. A cut at the end of a document is free, one at the end of a sentence costs a little, one inside a
sentence costs more; padding costs its length. The cheapest cuts follow from

    cost(j) = min over i with j - i <= capacity of cost(i) + capacity - (j - i) + penalty(j)

whose minimum over a sliding range a monotone queue gives in constant time a step.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import carry_modules
from .words import BLANK, flat, offsets_of, slices

CAPACITY = 4096
#: Penalties of a cut, in tokens of padding.
SENTENCE_CUT, INNER_CUT = 2, 32
#: A stretch without a sentence end may be cut at every so many tokens.
INNER_STEP = 256
#: Tokens after which the windows that no later document can change are given out; cuts do not depend on it.
PLANNED = 1 << 20
#: Words, and runs of characters between blanks, whose tokens a worker remembers.
REMEMBERED = 500_000
#: Longer ones are not remembered.
LONGEST_REMEMBERED = 64
#: Bytes of text that are encoded together.
SLICE_BYTES = 8 << 20


class Cuts:
    """The cheapest cuts of a stream of places, found as the places come.

    Every place remembers the cut before it on its cheapest way. A later place can only follow one that is still in the
    queue, so the cuts that the ways of all these have in common are settled.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.at, self.cost, self.back = [0], [0], [0]
        self.first = 0  # number of the place that the lists begin with, the last settled cut
        self.queue = deque([0])  # numbers of increasing place and increasing cost + place

    def add(self, places: list[int], fees: list[int]) -> None:
        """Further places, increasing and no more than `capacity` apart, and what a cut there costs."""
        at, cost, back, queue, first, capacity = self.at, self.cost, self.back, self.queue, self.first, self.capacity
        for place, fee in zip(places, fees, strict=True):
            while place - at[queue[0] - first] > capacity:
                queue.popleft()
            i = queue[0]
            level = cost[i - first] + at[i - first] + capacity + fee
            at.append(place)
            cost.append(level - place)
            back.append(i)
            while queue and cost[queue[-1] - first] + at[queue[-1] - first] >= level:
                queue.pop()
            queue.append(first + len(at) - 1)

    def _way(self, j: int) -> list[int]:
        """Places from the last settled cut to place number j."""
        way = []
        while True:
            way.append(self.at[j - self.first])
            if j == self.first:
                return way[::-1]
            j = self.back[j - self.first]

    def settled(self) -> list[int]:
        """The cuts that no later place can change, from the last settled one on; these are given out once."""
        open_ways = [-j for j in set(self.queue)]
        heapify(open_ways)
        while len(open_ways) > 1:
            before = -self.back[-heappop(open_ways) - self.first]
            if before not in open_ways:  # few: no more than the queue had
                heappush(open_ways, before)
        common = -open_ways[0]
        way = self._way(common)
        drop = common - self.first
        del self.at[:drop], self.cost[:drop], self.back[:drop]
        self.first = common
        return way

    def finished(self) -> list[int]:
        """All remaining cuts, up to the last place."""
        return self._way(self.first + len(self.at) - 1)


def best_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int) -> list[int]:
    """The cheapest cuts among places (increasing; from the stream's start 0 to its end), both ends included."""
    cuts = Cuts(capacity)
    cuts.add(places[1:].tolist(), penalties[1:].tolist())
    return cuts.finished()


def cut_places(sentence_ends: np.ndarray, length: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a document of `length` tokens may be cut, its end included, with their penalties."""
    marks = np.append(sentence_ends[sentence_ends < length], length)
    fees = np.full(len(marks), SENTENCE_CUT)
    fees[-1] = 0
    step = min(INNER_STEP, capacity)
    before = np.append(0, marks[:-1])
    far = np.flatnonzero(marks - before > step)
    if len(far):
        inner = np.concatenate([np.arange(before[i] + step, marks[i], step) for i in far])
        marks, fees = np.append(marks, inner), np.append(fees, np.full(len(inner), INNER_CUT))
        order = np.argsort(marks)
        marks, fees = marks[order], fees[order]
    return marks, fees


class Packer:
    """Takes documents one by one and returns finished pieces (document, start, length, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, ends_sentence: np.ndarray, planned: int = PLANNED):
        self.capacity, self.ends_sentence, self.planned = capacity, ends_sentence, planned
        self.cuts = Cuts(capacity)
        self.documents: deque[tuple] = deque()  # (document, its ids, where they start in the stream) not yet wholly given out
        self.length = self.asked = self.sequence = 0

    def add(self, document, ids: np.ndarray) -> list[tuple]:
        places, fees = cut_places(np.flatnonzero(self.ends_sentence[ids]) + 1, len(ids), self.capacity)
        self.cuts.add((places + self.length).tolist(), fees.tolist())
        self.documents.append((document, ids, self.length))
        self.length += len(ids)
        if self.length - self.asked < self.planned:
            return []
        self.asked = self.length
        return self._pieces(self.cuts.settled())

    def finish(self) -> list[tuple]:
        return self._pieces(self.cuts.finished())

    def _pieces(self, cuts: list[int]) -> list[tuple]:
        out = []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            while self.documents and self.documents[0][2] < high:
                document, ids, begin = self.documents[0]
                a, b = max(low, begin), min(high, begin + len(ids))
                out.append((document, a - begin, b - a, ids[a - begin: b - begin], len(ids), self.sequence, a - low))
                if begin + len(ids) > high:
                    break
                self.documents.popleft()
            self.sequence += 1
        return out


#: Letters and numbers below U+0180, in lower case; above it there are too many classes for a plain pattern.
_LETTERS, _NUMBERS = "a-zª\u00b5ºß-öø-\u017f", "0-9²³¹¼-¾"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
#: Characters that leave a run between blanks to the library: controls, the soft hyphen, and all from U+0180 on.
_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f\xad\u0180-\U0010ffff]")


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_ASCII_ALNUM = np.zeros(256, bool)
_ASCII_ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_ASCII_MARK = ~_ASCII_ALNUM & ~BLANK & (np.arange(256) < 0x80) & (np.arange(256) > 0x20) & (np.arange(256) != 0x7F)


def _tail(data: np.ndarray, inside: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where a run of ASCII marks begins that ends a run between blanks and follows a letter or digit: a token ends before it."""
    mark = _ASCII_MARK[data]
    if len(data) < 2:
        return np.zeros(len(data), bool)
    after_word = np.zeros(len(data), bool)
    after_word[1:] = _ASCII_ALNUM[data[:-1]]
    latin = (data[1:-1] >= 0x80) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7) & (data[:-2] == 0xC3)
    after_word[2:] |= latin
    begins = np.flatnonzero(mark & after_word & ~edge[:-1])
    # the first place from there on that is no mark, or that starts another text
    stop = np.flatnonzero(~mark | edge[:-1])
    next_stop = np.append(stop, len(data))[np.searchsorted(stop, begins, "right")]
    ended = np.append(~inside | edge[:-1], True)[next_stop]
    out = np.zeros(len(data), bool)
    out[begins[ended]] = True
    return out


class Encoder:
    """Token ids of texts, remembered by word. The tokenizer lower-cases, drops blanks, and no token reaches over one."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        # bytes as the characters that stand for them in the vocabulary: printable ones for themselves, the rest in order
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        names = self.tokenizer.get_vocab()
        self.ends_sentence = np.zeros(max(names.values()) + 1, bool)
        for name, i in names.items():
            self.ends_sentence[i] = name.removesuffix("</w>").endswith((".", "!", "?")) and name.endswith("</w>")
        self.kind = np.uint16 if len(self.ends_sentence) <= 1 << 16 else np.uint32

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Tokens of a run of characters without blanks that stands between places where no token reaches over."""
        got = self.older.get(chunk)
        if got is None:
            if _ODD.search(chunk):
                got = self.library(chunk)
            else:
                parts = _PARTS.findall(chunk.lower())
                if len(parts) == 1:
                    word = parts[0] if parts[0].isascii() else "".join(map(self.shown.__getitem__, parts[0].encode()))
                    got = np.array([t.id for t in self.model.tokenize(word)], self.kind).tobytes()
                else:
                    got = b"".join([self.chunk(p) if x is None else x for p, x in zip(parts, map(self.known.get, parts), strict=True)])
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[chunk] = got
        return got

    def texts(self, column: pa.Array, end: int) -> Iterator[np.ndarray]:
        """Tokens of each text, and the end token behind them. A token never reaches over a blank."""
        for low, high in slices(column, SLICE_BYTES):
            part = column[low:high]
            ids, bounds = self._slice(part, end)
            special = reduce(pc.or_, [pc.match_substring(part, s) for s in self.special], pa.array([False] * len(part)))
            for i, whole in enumerate(special.to_pylist()):
                if whole:
                    yield np.append(np.frombuffer(self.library(part[i].as_py()), self.kind), self.kind(end))
                else:
                    yield ids[bounds[i]: bounds[i + 1]]

    def _slice(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of a slice of texts, and where each text's begin."""
        offsets, data = offsets_of(column)
        data = data[int(offsets[0]): int(offsets[-1])]
        offsets = offsets.astype(np.int64) - int(offsets[0])
        inside = ~BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | edge[1:-1]
        opens |= _tail(data, inside, edge)
        starts = np.flatnonzero(opens)
        row = np.searchsorted(offsets, starts, "right") - 1
        kept = _LOWER[data[inside]]
        ends = np.append(np.cumsum(inside)[starts] - 1, len(kept)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(kept)).dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        got = [self.chunk(c) if x is None else x for c, x in zip(chunks, map(self.known.get, chunks), strict=True)]
        tokens = np.frombuffer(b"".join(got), self.kind)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // tokens.itemsize
        first = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        size = sizes[which]
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum()))
        out = np.full(len(place) + len(column), end, self.kind)
        out[place + np.repeat(row, size)] = tokens[place + np.repeat(first[which] - at, size)]
        many = np.bincount(row, size, len(column)).astype(np.int64) + 1
        return out, np.append(0, np.cumsum(many))


_encoders: dict[str, Encoder] = {}


def _tokens(model: str) -> Encoder:
    import public_tokenizers

    if model not in _encoders:
        _encoders[model] = Encoder(public_tokenizers.path(model))
    return _encoders[model]


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32())),
])
DIGEST = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(model: str, end: int, capacity: int, with_ids: bool, planned: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokens(model)
        packer = Packer(capacity, encoder.ends_sentence, planned)
        base = TaskContext.get().partitionId() << 40

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True))
            ids = columns.pop(3)
            columns.insert(3, [zlib.crc32(x.astype("<u4").tobytes()) for x in ids])
            columns[5] = [base + s for s in columns[5]]
            if with_ids:
                columns.append([x.tolist() for x in ids])
            fields = list(PIECES)[: len(columns)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))

        for batch in batches:
            documents = batch.column(0).to_pylist()
            for document, ids in zip(documents, encoder.texts(flat(batch.column(1)), end), strict=True):
                if pieces := packer.add(document, ids):
                    yield table(pieces)
        if pieces := packer.finish():
            yield table(pieces)

    return run


def pack(
    docs: DataFrame, capacity: int = CAPACITY, *, model: str = "word_bpe_49k.json", end: int = 2, with_ids: bool = True,
    text: str = "text", doc_id: str = "doc_id", planned: int = PLANNED,
) -> DataFrame:
    """Pieces of all documents in windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    Documents are packed in the order of their partition and nothing is shuffled; each partition ends with one window that
    may be short. A window's number is its partition's number times 2**40 plus its place there. A NULL text is empty: one
    piece of the end token. Every row counts, repeated rows and NULL ids too; other columns are left out.
    """
    carry_modules(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = DIGEST + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_pack(model, end, capacity, with_ids, planned), schema)
