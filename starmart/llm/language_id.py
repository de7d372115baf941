"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit of the code a binary classifier over byte n-grams tells the languages with a
one from those with a zero. A text's bits are decoded by loss: the language whose codeword costs least under the weighted
logistic loss of all bits is the answer, so a few wrong bits do no harm. A text whose two nearest codewords cost about the
same is flagged.

A classifier holds the logarithm of how much more frequent each n-gram is in the languages with a one. It is fitted on a
bounded sample of labelled texts, a fifth of which is left out to scale each bit and to weigh it by how often it errs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sketch import packed, unpacked
from .staging import carry_modules, staged
from .words import flat, offsets_of, slices

#: Lengths of n-grams in bytes, and the bits of their hash.
ORDERS, HASH_BITS = (2, 3, 4), 15
#: Labelled texts of a language that the classifiers are fitted on, on average at most.
SAMPLE_TEXTS = 4000
#: One in so many sampled texts is left out of the counts and scales the bits.
FOLDS = 5
#: Tasks that count the sample.
FIT_TASKS = 32
#: What every n-gram counts besides its occurrences.
SMOOTH = 0.25
#: Weights are whole numbers of this fraction, so sums do not depend on their order.
UNIT = 1 / 512
#: Codes have so many bits for each doubling of the languages, and 15 at least; up to five languages all bits there are.
BITS_PER_DOUBLING = 10
#: A prediction is ambiguous if its share of the two nearest languages is smaller.
SURE = 0.75
UNKNOWN = "und"

_SHOWN = np.full(256, 0x20, np.uint8)
_SHOWN[0x80:] = np.arange(0x80, 256)
for _i in range(26):
    _SHOWN[ord("a") + _i] = _SHOWN[ord("A") + _i] = ord("a") + _i
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True


# --- n-grams ------------------------------------------------------------------------------------------------

def grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the hashed n-grams of all texts, and where each text's begin; one more bound ends the last.

    Letters are lower-cased by A to Z, other ASCII characters are blanks, runs of blanks are one, and a blank stands before
    and after each text.
    """
    offsets, data = offsets_of(_padded(column))
    low, high = int(offsets[0]), int(offsets[-1])
    shown = _SHOWN[data[low:high]]
    offsets = offsets.astype(np.int64) - low
    blank = shown == 0x20
    keep = np.ones(len(shown), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1]] = True
    bounds = np.append(0, np.cumsum(keep))[offsets]
    shown = shown[keep].astype(np.uint32)
    for n in ORDERS:
        value = np.zeros(max(0, len(shown) - n + 1), np.uint32)
        for k in range(n):
            value = (value << np.uint32(8)) | shown[k: len(shown) - n + 1 + k]
        hashed = ((value + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)
        starts = np.arange(len(value))
        inside = starts + n <= np.repeat(bounds[1:], np.diff(bounds))[: len(value)]
        yield hashed[inside], np.append(0, np.cumsum(inside))[np.minimum(bounds, len(value))]


def _padded(column: pa.Array) -> pa.Array:
    """Each text between two blanks."""
    edge = pa.scalar(" ", pa.large_string())
    return pc.binary_join_element_wise(edge, column.cast(pa.large_string()), edge, pa.scalar("", pa.large_string()))


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script."""
    offsets, data = offsets_of(column)
    before = np.append(0, np.cumsum(_ASCII_LETTER[data[int(offsets[0]): int(offsets[-1])]]))
    at = offsets.astype(np.int64) - int(offsets[0])
    found = before[at[1:]] > before[at[:-1]]
    for i in np.flatnonzero(~found & (np.diff(at) > 0)).tolist():
        found[i] = any(map(str.isalpha, column[i].as_py()))
    return found


# --- codes and model ----------------------------------------------------------------------------------------

def codewords(languages: int) -> np.ndarray:
    """A row of bits for each language; no column is constant, and none repeats or inverts another.

    Up to five languages the code has every such column, else it is the best of some fixed random ones: that whose nearest
    two rows lie farthest apart.
    """
    if languages <= 5:
        columns = np.arange(1, 1 << max(0, languages - 1))
        return (columns[None, :] >> np.arange(languages)[:, None]) & 1
    bits = max(15, math.ceil(BITS_PER_DOUBLING * math.log2(languages)))
    best, reach = None, -1
    for seed in range(40):
        rng = np.random.default_rng(seed)
        code = rng.integers(0, 2, (languages, 4 * bits))
        code = np.where(code[:1] == 1, code, 1 - code)
        code = np.unique(code[:, code.min(axis=0) < 1], axis=1)
        code = code[:, rng.permutation(code.shape[1])[:bits]]
        sign = 2 * code - 1
        near = (code.shape[1] - sign @ sign.T) // 2 + np.eye(languages, dtype=int) * code.shape[1]
        if near.min() > reach:
            best, reach = code, near.min()
    return best


@dataclass
class Model:
    """Languages, their codewords, whole-number weights of the n-grams for each bit, and scale and weight of the bits."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray = field(default=None)
    trust: np.ndarray = field(default=None)

    @classmethod
    def of_counts(cls, languages: list[str], counts: np.ndarray) -> Model:
        """The classifiers of languages (rows) with n-gram counts (columns); each language weighs alike."""
        code = codewords(len(languages))
        share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
        ones = code / np.maximum(code.sum(axis=0), 1)
        zeros = (1 - code) / np.maximum((1 - code).sum(axis=0), 1)
        odds = np.log(share.T @ ones) - np.log(share.T @ zeros) if code.shape[1] else np.zeros((counts.shape[1], 0))
        bits = code.shape[1]
        return cls(languages, code, np.round(odds / UNIT).astype(np.int32), np.ones(bits), np.ones(bits))

    def margins(self, column: pa.Array) -> np.ndarray:
        """The evidence for a one, by text and bit: the sum of the weights over the root of the number of n-grams."""
        total, many = np.zeros((len(column), self.weights.shape[1]), np.int64), np.zeros(len(column), np.int64)
        for hashed, bounds in grams(column):
            many += np.diff(bounds)
            for low in range(0, len(hashed), 1 << 20):  # bounded memory, whatever the length of a text
                high = min(low + (1 << 20), len(hashed))
                cuts = np.clip(bounds, low, high) - low
                held = np.flatnonzero(np.diff(cuts))
                total[held] += np.add.reduceat(self.weights[hashed[low:high]], cuts[held], axis=0, dtype=np.int64)
        return total * UNIT / np.sqrt(np.maximum(many, 1))[:, None]

    def calibrated(self, margins: np.ndarray, truth: np.ndarray) -> Model:
        """Scale each bit to be most likely on left-out texts, and weigh it by the logarithm of its odds of being right."""
        want = 2 * self.code[truth] - 1
        steps = np.geomspace(0.02, 20, 60)
        scale, trust = np.ones(self.code.shape[1]), np.ones(self.code.shape[1])
        for b in range(self.code.shape[1]):
            own = want[:, b] * margins[:, b]
            scale[b] = steps[np.argmin([np.logaddexp(0, -s * own).sum() for s in steps])]
            wrong = ((own <= 0).sum() + 0.5) / (len(own) + 1)
            trust[b] = max(0.05, math.log((1 - wrong) / wrong))
        return Model(self.languages, self.code, self.weights, scale, trust / trust.sum() * len(trust) if len(trust) else trust)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, whether ambiguous) of the nearest codeword of each text."""
        n = len(margins)
        if len(self.languages) == 1:
            return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
        signs = 2 * self.code - 1
        z = margins * self.scale
        one, zero = np.logaddexp(0, -z) * self.trust, np.logaddexp(0, z) * self.trust
        loss = one @ (signs.T > 0) + zero @ (signs.T < 0)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        best = np.argmin(loss, axis=1)
        two = np.sort(likely, axis=1)[:, -2:]
        return best, likely.max(axis=1) / likely.sum(axis=1), two[:, 1] / two.sum(axis=1) < SURE


# --- Spark --------------------------------------------------------------------------------------------------

def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(labelled: DataFrame, texts: int) -> DataFrame:
    """About `texts` of each language's rows at most, chosen by a hash; (lang, fold, text)."""
    share = F.broadcast(labelled.groupBy("lang").agg((F.lit(float(texts)) / F.count(F.lit(1))).alias("share")))  # a row a language
    drawn = F.pmod(F.xxhash64("text", "salt"), F.lit(1 << 30)) / float(1 << 30)
    fold = F.pmod(F.xxhash64("text", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return labelled.join(share, "lang").where(drawn < F.col("share")).select("lang", fold.alias("fold"), "text", "salt")


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang in set(langs):
            own = flat(batch.column(1).filter(pa.array([x == lang for x in langs])))
            total = held.setdefault(lang, np.zeros(1 << HASH_BITS, np.int64))
            for low, high in slices(own):
                for hashed, _ in grams(own[low:high]):
                    total += np.bincount(hashed, minlength=len(total))
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([packed(v) for v in held.values()], pa.binary())], names=["lang", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = sum(unpacked(c.as_py(), 1 << HASH_BITS, np.int64) for c in table["counts"])
    return pa.table({"lang": [table["lang"][0].as_py()], "counts": pa.array([packed(total)], pa.binary())})


def fit(labelled: DataFrame, *, sample_texts: int = SAMPLE_TEXTS) -> Model | None:
    """The model of (lang, text) rows, NULL in neither; None without any.

    At most about `sample_texts` rows a language are used, chosen by hash, each with its whole text. The driver holds a row
    of 32,768 counts for each language and the margins of a fifth of the sample, whatever the size of the table.
    """
    carry_modules(labelled.sparkSession)
    sample = staged(_sample(labelled, sample_texts).repartition(FIT_TASKS, F.xxhash64("text", "salt")), "language-sample")
    partial = sample.where("fold > 0").select("lang", "text").mapInArrow(_count_grams, "lang string, counts binary")
    rows = partial.groupBy("lang").applyInArrow(lambda t: _summed(t), "lang string, counts binary").collect()
    left = sample.where("fold = 0").select("lang", "text")
    if not rows:  # a handful of texts, all of them left out
        rows = left.mapInArrow(_count_grams, "lang string, counts binary").groupBy("lang").applyInArrow(lambda t: _summed(t), "lang string, counts binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["lang"])
    model = Model.of_counts([r["lang"] for r in rows], np.stack([unpacked(bytes(r["counts"]), 1 << HASH_BITS, np.int64) for r in rows]))
    if len(model.languages) == 1:
        return model

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = flat(batch.column(1))
            for low, high in slices(texts):
                margins = model.margins(texts[low:high])
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(list(margins), pa.list_(pa.float64()))], names=["lang", "margins"])

    known = {lang: i for i, lang in enumerate(model.languages)}
    checked = [r for r in left.mapInArrow(measure, "lang string, margins array<double>").toArrow().to_pylist() if r["lang"] in known]
    checked.sort(key=lambda r: (r["lang"], r["margins"]))
    if not checked:
        return model
    return model.calibrated(np.array([r["margins"] for r in checked]), np.array([known[r["lang"]] for r in checked]))


def predict(docs: DataFrame, model: Model | None, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row, from its text alone.

    A text that is NULL, empty or without a letter, or any text where nothing was learned, is `und` with score 0.
    """
    carry_modules(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = flat(batch.column(1))
            for low, high in slices(texts):
                own = texts[low:high]
                n = len(own)
                names, scores, doubt = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
                told = np.flatnonzero(has_letter(own)) if model else np.zeros(0, np.int64)
                if len(told):
                    best, scores[told], doubt[told] = model.decode(model.margins(own.take(pa.array(told))))
                    names[told] = np.array(model.languages, object)[best]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[low:high], pa.array(names, pa.string()), pa.array(scores), pa.array(doubt)],
                    names=["doc_id", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, *, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row of (doc_id, text, lang).

    Learned from the rows with language and text that are not held out. Repeated rows each get their row; a row without an
    id is predicted, not learned from, and not held out. Other columns are left out.
    """
    labelled = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("string").alias("salt"))
    return predict(docs, fit(labelled, sample_texts=sample_texts)).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous")
