"""Phrases whose words stand together more often than their frequencies explain, mined by sorting suffixes.

Every word of a text starts a suffix of up to `depth` words of its piece. A task counts the equal suffixes of a slice of
text, so that a phrase costs one row a slice however often it occurs there, and sends these rows in packed messages.

Rows are routed by their first word. The messages' sizes then show which groups are overfull, and only these are routed
again, by more bits of the first word's hash, by the first two words, and so on up to all words; equal rows are put together
on the way. So no group grows with a word's frequency, and nothing is guessed or broadcast.

A group sorts its suffix pointers by multikey three-way quicksort, all partitions of a level at once: elements are parted
into less than, equal to and greater than their partition's pivot word; the equal part goes on with the next word. Its size
is the count of the phrase so far. A part that cannot hold a frequent phrase is abandoned. Where a phrase is spread over
groups its counts add up, and nothing shorter than the routed words is abandoned.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sketch import packed, runs_of, unpacked
from .staging import carry_modules, parts, staged, text_bytes
from .words import flat, mix, offsets_of, slices

DEPTH, LEAST, INSIDE_PERCENT, TOP = 3, 10, 50, 2000
#: Bytes of text whose suffixes are counted together.
SLICE_BYTES = 2 << 20
#: Bytes of text for each word and what parts it; only the number of groups rests on it.
WORD_BYTES = 6
#: Suffix rows of a group on average; one with over twice as many is routed again.
GROUP_ROWS = 250_000
#: Groups that a message's rows are dealt to at most in one step.
FAN = 1024
#: Bytes of messages that are handed on together, and that a writer holds.
MESSAGE_BYTES, ROW_GROUP = 2 << 20, 16 << 20
#: Parts of a language whose best phrases are picked first.
SPREAD = 64
NO_LANG = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[0x20, 0x09]] = True


# --- suffixes of a slice ------------------------------------------------------------------------------------

def word_codes(column: pa.Array) -> tuple[np.ndarray, pa.StringArray, np.ndarray, np.ndarray]:
    """The words of a string array, lower-cased by A to Z: code of each, the distinct words, row and piece of each."""
    offsets, data = offsets_of(column)
    low, high = int(offsets[0]), int(offsets[-1])
    data = _LOWER[data[low:high]]
    offsets = offsets.astype(np.int64) - low
    inside = ~_OUTSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(opens)
    row = np.searchsorted(offsets, starts, "right") - 1
    # words of one row with no break between them are of one piece
    piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts] + row
    kept = data[inside]
    ends = np.cumsum(inside, dtype=np.int32)[starts] - 1
    bounds = np.append(ends, len(kept)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(kept)))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, row, piece


def suffixes(codes: np.ndarray, piece: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each word the codes of itself and the next ones of its piece, -1 beyond it."""
    out = [codes]
    for k in range(1, depth):
        shifted = np.full(len(codes), -1, np.int32)
        if len(codes) > k:
            together = piece[k:] == piece[:-k]
            shifted[:-k][together] = codes[k:][together]
        out.append(shifted)
    return out


def equal_rows(columns: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A row of each class of equal rows, in their order, and the weight of the class. Values are -1 or more."""
    key, size = np.zeros(columns.shape[1], np.int64), 1
    for c in columns:
        width = int(c.max(initial=0)) + 2
        if size * width >= 1 << 62:  # keep the product in 64 bits
            values, key = np.unique(key, return_inverse=True)
            key = key.astype(np.int64)
            size = len(values)
        key *= width
        key += c
        key += 1
        size *= width
    if weight is None:
        _, first, total = np.unique(key, return_index=True, return_counts=True)
    else:
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, which, weight)
    return first, total.astype(np.int64)


# --- messages -----------------------------------------------------------------------------------------------

MESSAGES = "g long, part long, rows int, held int, words binary, lengths binary, codes binary, weights binary, lang string, total long"
_MESSAGES = pa.schema([
    ("g", pa.int64()), ("part", pa.int64()), ("rows", pa.int32()), ("held", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()),
    ("codes", pa.binary()), ("weights", pa.binary()), ("lang", pa.string()), ("total", pa.int64())])


class Rows:
    """Distinct weighted suffixes: codes of the language and of each word (-1 where the suffix has ended) in one list of words."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray, words: pa.StringArray):
        self.keys, self.weight, self.words = keys, weight, words

    @classmethod
    def read(cls, table: pa.Table, depth: int) -> Rows:
        """The rows of all messages of a table, equal ones put together."""
        import zstandard

        lists, keys, weights = [], [], []
        for r in table.select(["rows", "held", "words", "lengths", "codes", "weights"]).to_pylist():
            ends = np.cumsum(unpacked(r["lengths"], r["held"], np.int32), dtype=np.int64)
            text = zstandard.ZstdDecompressor().decompress(r["words"], max_output_size=max(1, int(ends[-1])))
            lists.append(pa.LargeStringArray.from_buffers(r["held"], pa.py_buffer(np.append(0, ends)), pa.py_buffer(text)))
            keys.append(unpacked(r["codes"], r["rows"] * (depth + 1), np.int32).reshape(depth + 1, -1) - np.int32(1))
            weights.append(unpacked(r["weights"], r["rows"], np.int64))
        coded = pa.concat_arrays(lists).dictionary_encode()
        code, low = coded.indices.to_numpy(), 0
        for i, k in enumerate(keys):
            keys[i] = np.where(k < 0, np.int32(-1), code[low + k])
            low += len(lists[i])
        whole = np.concatenate(keys, axis=1)
        first, weight = equal_rows(whole, np.concatenate(weights))
        return cls(whole[:, first], weight, coded.dictionary)

    def routed(self, words: int, fan: int, salt: int, part: int) -> Iterator[dict]:
        """Messages of the rows, dealt into `fan` groups by their language and first `words` words."""
        own = np.fromiter((zlib.crc32(w.encode()) for w in self.words.to_pylist()), np.uint64, len(self.words))
        spread = np.full(len(self.weight), salt & (2**64 - 1), np.uint64)
        for k in self.keys[: words + 1]:
            spread = mix(spread ^ np.where(k < 0, np.uint64(0), own[k] + np.uint64(1)))
        group = ((spread >> np.uint64(32)) * np.uint64(fan) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        for a, b in runs_of(group[order]):
            name = int(mix(np.array([(salt + int(group[order[a]])) & (2**64 - 1)], np.uint64))[0] >> np.uint64(1))
            yield {"g": name, "part": part, "rows": b - a, **self._packed(order[a:b])}

    def _packed(self, at: np.ndarray) -> dict:
        import zstandard

        keys = self.keys[:, at]
        used = np.unique(keys)
        used = used[used >= 0]
        codes = np.where(keys < 0, 0, np.searchsorted(used, keys) + 1).astype(np.int32)
        offsets, text = offsets_of(self.words.take(pa.array(used)))
        return {
            "held": len(used), "words": zstandard.ZstdCompressor(level=1).compress(text[offsets[0]: offsets[-1]].tobytes()),
            "lengths": packed(np.diff(offsets).astype(np.int32)), "codes": packed(codes.reshape(-1)), "weights": packed(self.weight[at])}


def _tables(rows: Iterator[dict], limit: int = MESSAGE_BYTES) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(r[k]) for k in ("words", "lengths", "codes", "weights") if r.get(k) is not None)
        if size >= limit:
            yield pa.RecordBatch.from_pylist(held, _MESSAGES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _MESSAGES)


def _send(depth: int, fan: int, slice_bytes: int) -> Callable:
    """Counts the suffixes of slices of (lang, text) and deals them out by their first word; adds up words by language."""
    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId() << 32
        for batch in _gathered(batches, slice_bytes):
            langs = batch.column(0).dictionary_encode()
            texts = flat(batch.column(1))
            for low, high in slices(texts, slice_bytes):
                codes, words, row, piece = word_codes(texts[low:high])
                if not len(codes):
                    continue
                of = langs.indices.to_numpy()[low:high][row]
                columns = np.stack([of + np.int32(len(words)), *suffixes(codes, piece, depth)])
                first, weight = equal_rows(columns)
                for i, n in enumerate(np.bincount(of, minlength=len(langs.dictionary)).tolist()):
                    if n:
                        yield {"lang": langs.dictionary[i].as_py(), "total": n}
                part += 1
                yield from Rows(columns[:, first], weight, pa.concat_arrays([words, langs.dictionary])).routed(1, fan, 0, part)
            del batch, langs, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tables(messages(batches))

    return run


def _dealt_again(dealt: DataFrame, depth: int, words: int) -> DataFrame:
    """Messages of the chunks (g, chunk) of overfull groups, dealt out by `words` words."""
    def run(table: pa.Table) -> pa.Table:
        g, part, fan = table["g"][0].as_py(), pc.min(table["part"]).as_py(), table["fan"][0].as_py()
        return pa.Table.from_batches(_tables(Rows.read(table, depth).routed(words, fan, g + words, part)), _MESSAGES)

    return dealt.groupBy("g", "chunk").applyInArrow(lambda table: run(table), MESSAGES)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until their texts reach `limit` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        del b  # no batch is kept while the next one is read
        if size >= limit:
            whole, held, size = _one(held), [], 0
            yield whole
            del whole
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0] if any(len(b) for b in held) else held[0]


# --- quicksort of a group -----------------------------------------------------------------------------------

def multikey_counts(keys: list[np.ndarray], weight: np.ndarray, least: int, whole: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Counts of the prefixes of weighted suffixes, as (words of the prefix, a suffix that starts with it, its weight).

    `keys` holds the words at each depth, -1 where a suffix has ended. Of prefixes of `whole` words or more all suffixes are
    here, so those under `least` are abandoned and left out; shorter ones are counted in part.

    Multikey three-way quicksort, one level of partitions at a time: `pointer` is cut into segments, each with the depth of
    the word it is parted by.
    """
    pointer = np.flatnonzero(keys[0] >= 0)
    table = np.stack(keys)
    segment = np.zeros(min(1, len(pointer)), np.int64)  # where each segment starts in `pointer`
    depth = np.zeros(len(segment), np.int64)
    while len(pointer):
        size = np.diff(np.append(segment, len(pointer)))
        of = np.repeat(np.arange(len(segment)), size)
        word = table[depth[of], pointer]
        pivot = _middle(word, segment, size)
        part = of * 3 + 1 + np.sign(word - pivot[of])
        count = np.bincount(part, minlength=3 * len(segment))
        heavy = np.bincount(part, weight[pointer], minlength=3 * len(segment))
        # three-way split in place: a stable counting sort by part
        begin = np.cumsum(count) - count
        place = np.argsort(part, kind="stable")
        pointer = pointer[place]
        # what goes on: a lesser or greater part if it may hold a frequent phrase, an equal part if there are more words
        level = np.repeat(depth, 3)
        equal = np.arange(len(count)) % 3 == 1
        frequent = (heavy >= least) | (level + 1 < whole)
        for d in range(len(keys)):
            found = np.flatnonzero(equal & (level == d) & frequent)
            if len(found):
                yield d + 1, pointer[begin[found]], heavy[found].astype(np.int64)
        level = level + equal
        goes = (count > 0) & frequent & (level < len(keys))
        kept = np.repeat(goes, count)
        pointer, owner = pointer[kept], np.repeat(np.arange(len(count)), count)[kept]
        # suffixes that have ended are parted no further
        alive = table[level[owner], pointer] >= 0
        pointer, owner = pointer[alive], owner[alive]
        segment = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
        depth = level[owner[segment]]


def _middle(word: np.ndarray, segment: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pivots: the median of the first, middle and last word of each segment."""
    a, b, c = word[segment], word[segment + size // 2], word[segment + size - 1]
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def _count(depth: int, least: int) -> Callable:
    """Counts of the frequent phrases of a group."""
    kinds = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        rows = Rows.read(table, depth)
        out = [kinds.empty_table()]
        # the language is the first key, so a phrase of k words has k + 1 keys
        for length, at, n in multikey_counts(list(rows.keys), rows.weight, least, table["whole"][0].as_py() + 1):
            if length == 1:
                continue
            lang, *words = (rows.words.take(pa.array(k[at])).cast(pa.string()) for k in rows.keys[:length])
            phrase = pc.binary_join_element_wise(*words, " ") if len(words) > 1 else words[0]
            out.append(pa.Table.from_arrays([lang, phrase, pa.array(np.full(len(at), length - 1, np.int32)), pa.array(n)], schema=kinds))
        return pa.concat_tables(out)

    return run


def phrase_counts(
    docs: DataFrame, *, depth: int = DEPTH, least: int = LEAST, slice_bytes: int = SLICE_BYTES, group_rows: int = GROUP_ROWS, fan: int = FAN,
    text: str = "text", lang: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of up to `depth` words that occur at least `least` times, and (lang, n) of all words."""
    carry_modules(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    groups = parts(text_bytes(rows) // WORD_BYTES, group_rows)
    digits = 1
    while fan ** digits < groups:
        digits += 1
    sent = staged(rows.mapInArrow(_send(depth, min(fan, groups), slice_bytes), MESSAGES), "suffixes", ROW_GROUP)
    totals = sent.where("total IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("n"))
    body = ["g", "part", "rows", "held", "words", "lengths", "codes", "weights"]
    now = sent.where("total IS NULL").select(*body)
    ready: DataFrame | None = None
    steps = [words for words in range(1, depth + 1) for _ in range(digits)]
    for words, following in zip(steps, [*steps[1:], None], strict=True):
        placed = now.withColumn("whole", F.lit(words))
        if following is None:
            ready = placed if ready is None else ready.unionByName(placed)
            break
        sizes = now.groupBy("g").agg(F.sum("rows").alias("size")).where(F.col("size") > 2 * group_rows)
        sizes = staged(sizes, "overfull")
        fits = placed.join(sizes, "g", "left_anti")
        ready = fits if ready is None else ready.unionByName(fits)
        if sizes.isEmpty():
            break
        chunks = F.ceil(F.col("size") / group_rows)
        dealt = now.join(sizes, "g").withColumns({
            "chunk": F.pmod(F.xxhash64("part"), chunks), "fan": F.least(F.lit(fan), 2 * chunks).cast("int")}).drop("size")
        now = staged(_dealt_again(dealt, depth, following), "suffixes", ROW_GROUP).select(*body)
    count = _count(depth, least)
    counted = ready.groupBy("whole", "g").applyInArrow(lambda t: count(t), "lang string, phrase string, size int, n long")
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least), totals


# --- scores -------------------------------------------------------------------------------------------------

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exactly: products of up to 38 digits."""
    wide = [c.cast("decimal(16,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def scored(counts: DataFrame, *, depth: int = DEPTH, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer one holds too often.

    A phrase is scored at the cut with the lowest score, the first such. It goes if some longer phrase that contains it
    reaches `inside_percent` of its count.
    """
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), cut.alias("k")).withColumns({
        "first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
        "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    known = counts.select("lang", "phrase", "n")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts_of = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    holders = counts.where("size > 2").select("lang", F.explode(parts_of).alias("phrase"), F.col("n").alias("b"))
    holders = holders.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    kept = best.join(holders, ["lang", "phrase"], "left").where(F.col("b").isNull() | (F.col("b") * 100 < F.col("a") * inside_percent))
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def best_phrases(phrases: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language by score, count and bytes; picked in parts of a language first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    spread = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    near = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, *, depth: int = DEPTH, least: int = LEAST, inside_percent: int = INSIDE_PERCENT, top: int | None = TOP,
    slice_bytes: int = SLICE_BYTES, group_rows: int = GROUP_ROWS, fan: int = FAN, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of 2 to `depth` words of each language; without `top` all, unranked.

    Texts are lower-cased by A to Z and cut into pieces at ``.,;:!?`` and line ends, and these into words at spaces and tabs;
    a phrase lies in one piece. All counts are those of a language over the whole table; a NULL language is `und`, a NULL or
    empty text has no words. Every row counts, repeated rows too. Other columns are left out.
    """
    counts, totals = phrase_counts(
        docs, depth=depth, least=least, slice_bytes=slice_bytes, group_rows=group_rows, fan=fan, text=text, lang=lang)
    phrases = scored(staged(counts, "phrases"), depth=depth, inside_percent=inside_percent)
    if top is None:
        return phrases.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")
    return best_phrases(phrases, totals, top)
