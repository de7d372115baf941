"""Token counts by a compiled transducer.

The tokenizer merges the best pair first. A sequence of pieces is its result exactly if no two neighbours would have been
merged across, so the result of a text's prefix ends in one certain last piece, and a longer prefix only adds to what
came before. This gives a deterministic transducer: its state holds, for every suffix that can still become part of a
piece, the last piece before that suffix and the count there; a transition reads one character and is annotated with the
change of the number of emitted pieces. States and transitions are compiled when first reached and kept.

Blanks start words, no piece reaches over the start of a word, and characters outside the vocabulary stand alone as
bytes. Each of these returns the transducer to its initial state. A chunk of text is therefore a small state map: what it
adds before its first return (which depends on the state at entry), the count inside, and the open word at its end. Maps
compose associatively, and the maps of a text's chunks are composed by a parallel prefix scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import carry_modules

SPACE, LINE = "▁", "\n"
DOUBLE = SPACE + SPACE
#: Code points of a chunk; longer texts are composed of several.
CHUNK = 1 << 15
#: Words whose counts a worker remembers.
REMEMBERED = 400_000
#: Compiled states that a worker keeps.
STATES = 300_000


class Transducer:
    """Piece counts of words for a best-pair-first vocabulary: `scores` by piece, the larger merged first.

    A piece must rank below the pieces it is merged from, as it does when the vocabulary was trained by merging.
    """

    def __init__(self, scores: dict[str, float]):
        self.pieces = sorted(scores, key=lambda p: -scores[p])
        self.rank = {p: i for i, p in enumerate(self.pieces)}
        self.letters = {p for p in scores if len(p) == 1}
        # all beginnings of pieces as a tree: children by letter, and the piece that ends at a node
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for piece, rank in self.rank.items():
            node = 0
            for letter in map(ord, piece):
                after = self.children[node].get(letter)
                if after is None:
                    after = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = after
            self.ends[node] = rank
        self._made: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        """Forget compiled states. State 0 is the initial one, before any letter."""
        start = (0, -1, 0)
        self._numbers: dict[tuple[int, ...], int] = {start: 0}
        self._states: list[tuple[int, ...]] = [start]
        #: next state * 256 + change of the count + 128, by state * 2**21 + letter
        self.next: dict[int, int] = {}

    def merge(self, symbols: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """Merge the best neighbouring pair, the leftmost among equals, until none is left; also the last pair merged."""
        symbols, last = list(symbols), None
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                rank = self.rank.get(symbols[i] + symbols[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return symbols, last
            last = (symbols[at], symbols[at + 1])
            symbols[at: at + 2] = ["".join(last)]

    def made(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge gives this one, (-1, -1) for a letter; None if merging its letters does not give it."""
        if piece not in self._made:
            text = self.pieces[piece]
            left, last = self.merge(list(text))
            self._made[piece] = None if len(left) > 1 else (self.rank[last[0]], self.rank[last[1]]) if last else (-1, -1)
            if len(left) == 1 and last and any(len(p) > 1 and self.rank[p] > piece for p in last):
                raise ValueError(f"{text!r} is merged before a part of it: the vocabulary does not come from merges")
        return self._made[piece]

    def apart(self, left: int, right: int) -> bool:
        """Whether two pieces stay as they are side by side.

        Their merges are undone from the latest back. At each moment the pieces at the border must not form a pair that
        would have gone before the merge just undone.
        """
        limit = len(self.pieces)  # a pair across the border ranked below this would have been merged
        while True:
            across = self.rank.get(self.pieces[left] + self.pieces[right])
            if across is not None and across < limit:
                return False
            a, b = self.made(left), self.made(right)
            in_left, in_right = a[0] >= 0, b[0] >= 0
            if not in_left and not in_right:
                return True
            # of equal pairs the left one goes first, so the right side's merge is the later one
            if in_left and (not in_right or left > right):
                limit, left = left, a[1]
            else:
                limit, right = right + 1, b[0]

    def step(self, state: int, letter: int) -> int:
        """Compile one transition."""
        key = self._states[state]
        children, ends = self.children, self.ends
        # a place: a node (the text since it), the last piece before it, the count there less the count here
        moved, found, change = [], -1, 0
        for i in range(0, len(key), 3):
            node = children[key[i]].get(letter)
            if node is None:
                continue
            last, count = key[i + 1], key[i + 2]
            piece = ends[node]
            if found < 0 and piece >= 0 and self.made(piece) is not None and (last < 0 or self.apart(last, piece)):
                found, change = piece, count + 1
            if children[node]:
                moved.append((node, last, count))
        if found < 0:
            raise ValueError(f"no piece ends with {chr(letter)!r}")
        after = tuple(x for node, last, count in moved for x in (node, last, count - change)) + (0, found, 0)
        number = self._numbers.get(after)
        if number is None:
            number = self._numbers[after] = len(self._states)
            self._states.append(after)
        out = self.next[(state << 21) | letter] = (number << 8) | (change + 128)
        return out

    def count(self, word: str) -> int | None:
        """Pieces of a word; None if it has a letter outside the vocabulary."""
        if len(self._states) > STATES:
            self.reset()
        total, state, following = 0, 0, self.next
        for letter in map(ord, word):
            got = following.get((state << 21) | letter)
            if got is None:
                if letter not in self.children[0]:
                    return None
                got = self.step(state, letter)
            state = got >> 8
            total += (got & 255) - 128
        return total


@dataclass(frozen=True)
class ChunkMap:
    """A chunk's state map. Without a return (`closed` false) the chunk is one open piece of a word, held in `head`."""

    head: str = ""
    inner: int = 0
    tail: str = ""
    closed: bool = False

    def then(self, other: ChunkMap, counter: Counter) -> ChunkMap:
        """This map followed by another."""
        if not self.closed:
            return ChunkMap(self.head + other.head, other.inner, other.tail, other.closed)
        if not other.closed:
            return ChunkMap(self.head, self.inner, self.tail + other.head, True)
        return ChunkMap(self.head, self.inner + counter.word(self.tail + other.head) + other.inner, other.tail, True)


def scan(maps: list[ChunkMap], counter: Counter) -> ChunkMap:
    """Compose neighbouring maps pairwise until one is left: a scan of logarithmic depth, of which the total is kept."""
    while len(maps) > 1:
        maps = [maps[i].then(maps[i + 1], counter) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0] if maps else ChunkMap(closed=True)


class Counter:
    """Counts the pieces of texts with a sentencepiece best-pair-first vocabulary with byte fallback."""

    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        special = {i for i in range(library.get_piece_size())
                   if library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i)}
        scores = {library.id_to_piece(i): library.get_score(i) for i in range(library.get_piece_size()) if i not in special}
        if any(SPACE in p.lstrip(SPACE) for p in scores):
            raise ValueError("a piece reaches over the start of a word")
        self.transducer = Transducer(scores)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def word(self, word: str, before: str = "") -> int:
        """Pieces of one word: blanks, then no blank, with any characters. `before` is a blank left off the word."""
        if not before and word[:1] == SPACE and word[1:2] != SPACE:
            word, before = word[1:], SPACE
        if not before:
            return self._read(word)
        got = self.known.get(word)
        if got is None:
            got = self.older.get(word)
            if got is None:
                got = self._read(before + word)
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            if len(word) <= 64:
                self.known[word] = got
        return got

    def _read(self, word: str) -> int:
        known = self.transducer.count(word)
        if known is not None:
            return known
        letters, total, start = self.transducer.letters, 0, 0
        for i, letter in enumerate(word):
            if letter not in letters:  # stands alone, as its bytes
                total += self.transducer.count(word[start:i]) + len(letter.encode())
                start = i + 1
        return total + self.transducer.count(word[start:])

    def line(self, text: str) -> ChunkMap:
        """The state map of normalised text without a line end. A return is a blank after anything but a blank."""
        words = text.split(SPACE)
        if len(words) == 1:
            return ChunkMap(text)
        if DOUBLE not in text and words[0] and words[-1]:  # each word has one blank before it
            inner = list(map(self.known.get, words[1:-1]))
            if None in inner:
                inner = [self.word(w, SPACE) if n is None else n for w, n in zip(words[1:-1], inner, strict=True)]
            return ChunkMap(words[0], sum(inner), SPACE + words[-1], True)
        # blanks before a word belong to it
        glued, blanks = [words[0]], 0
        for w in words[1:]:
            blanks += 1
            if w:
                glued.append(SPACE * blanks + w)
                blanks = 0
        if blanks:
            glued.append(SPACE * blanks)
        if not glued[0]:  # blanks at the start may continue blanks before the chunk
            glued.pop(0)
        if len(glued) == 1:
            return ChunkMap(glued[0])
        return ChunkMap(glued[0], sum(map(self.word, glued[1:-1])), glued[-1], True)

    def whole(self, m: ChunkMap) -> int:
        """The count of a map entered in the initial state and left at its end."""
        return self.word(m.head) + m.inner + (self.word(m.tail) if m.closed else 0)

    def chunk(self, text: str) -> ChunkMap:
        """The state map of a chunk of normalised text. A line end, a byte of its own, is a return as well."""
        if LINE in self.transducer.letters:
            return self.line(text)
        lines = text.split(LINE)
        if len(lines) == 1:
            return self.line(text)
        first, last = self.line(lines[0]), self.line(lines[-1])
        inner = len(lines) - 1 + sum(self.whole(self.line(x)) for x in lines[1:-1])
        inner += first.inner + (self.word(first.tail) if first.closed else 0)
        if last.closed:
            return ChunkMap(first.head, inner + self.word(last.head) + last.inner, last.tail, True)
        return ChunkMap(first.head, inner, last.head, True)

    def text(self, text: str, chunk: int = CHUNK) -> int:
        """Pieces of a whole text, as the library counts them without begin and end."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        return self.whole(scan([self.chunk(text[i: i + chunk]) for i in range(0, len(text), chunk)], self))


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, in one pass without a shuffle.

    `model` is a file of the public tokenizers, looked up on each executor. A NULL text counts as empty: 0 bytes and 0
    tokens. Repeated rows and NULL ids stay as they are; other columns are left out.
    """
    carry_modules(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        if model not in _counters:
            _counters[model] = Counter(public_tokenizers.path(model))
        counter = _counters[model]
        for batch in batches:
            counts = [counter.text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
