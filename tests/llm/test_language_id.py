"""Language identification: n-grams and margins against plain loops, codes, decoding, held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import language_id as L

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"aa": ["ka", "lo", "mi", "ten"], "bb": ["sch", "ei", "ung", "ß"], "cc": ["é", "que", "oi", "ment"], "dd": ["漢", "字", "の"]}
TEXTS = ["", "x", "Hello,  World!", "été 漢字", "a\n\tb", "12 34", "The the THE " * 50, " \x00é "]


def make(seed, n, langs=SYLLABLES):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(langs))
        text = " ".join("".join(rng.choices(langs[lang], k=rng.randrange(1, 4))) for _ in range(rng.choice([2, 10, 60])))
        rows.append((i, text, lang))
    return rows


def plain_grams(text):
    shown = bytes(L._SHOWN[b] for b in b" " + text.encode() + b" ")
    while b"  " in shown:
        shown = shown.replace(b"  ", b" ")
    return [[shown[i: i + n] for i in range(len(shown) - n + 1)] for n in L.ORDERS]


def plain_hash(gram):
    return ((int.from_bytes(gram, "big") + len(gram)) * 0x9E3779B1 % 2**32) >> (32 - L.HASH_BITS)


def test_grams_of_each_text():
    for order, (hashed, bounds) in zip(range(len(L.ORDERS)), L.grams(pa.array(TEXTS)), strict=True):
        for i, text in enumerate(TEXTS):
            assert hashed[bounds[i]: bounds[i + 1]].tolist() == [plain_hash(g) for g in plain_grams(text)[order]]


def test_margins_against_loops_in_any_slices():
    rng = np.random.default_rng(1)
    model = L.Model.of_counts(list("abc"), rng.integers(0, 9, (3, 1 << L.HASH_BITS)))
    whole = model.margins(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        found = [plain_hash(g) for order in plain_grams(text) for g in order]
        want = model.weights[found].astype(np.int64).sum(axis=0) * L.UNIT / np.sqrt(max(1, len(found)))
        assert (whole[i] == want).all() and (model.margins(pa.array([text]))[0] == want).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 30, 150])
def test_codewords_lie_apart(n):
    code = L.codewords(n)
    rows = {tuple(r) for r in code.tolist()}
    assert len(rows) == n or n == 1
    columns = [tuple(c) for c in code.T.tolist()]
    assert len({min(c, tuple(1 - x for x in c)) for c in columns}) == len(columns)
    assert all(0 < sum(c) < n for c in columns)
    if n > 5:  # several wrong bits still decode
        assert min(sum(a != b for a, b in zip(x, y, strict=True)) for x in rows for y in rows if x != y) >= code.shape[1] // 5


def test_wrong_bits_are_corrected():
    code = L.codewords(6)
    model = L.Model(list("abcdef"), code, np.zeros((1, code.shape[1]), np.int32), np.ones(code.shape[1]), np.ones(code.shape[1]))
    for lang in range(6):
        z = (2.0 * code[lang] - 1) * 4
        z[0] *= -0.5
        best, score, doubt = model.decode(z[None])
        assert best[0] == lang and 0 < score[0] <= 1 and not doubt[0]
    _, _, doubt = model.decode(np.zeros((1, code.shape[1])))
    assert doubt[0]


def test_held_out_accuracy_and_shape(spark):
    rows = make(3, 900)
    got = L.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    tested = [r for r in got if r.held_out]
    assert len(tested) > 200 and sum(r.lang_pred == truth[r.doc_id] for r in tested) / len(tested) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_of_held_out_rows_is_learned(spark):
    """Neither the language of a held-out row nor other columns change a prediction."""
    rows = make(4, 300)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    changed = [(i, t, "zz" if i in held else g) for i, t, g in rows]
    a, b = (sorted(map(tuple, L.identify(spark.createDataFrame(x, SCHEMA).repartition(k)).collect())) for x, k in ((rows, 2), (changed, 5)))
    assert a == b and all(r[2] != "zz" for r in a)


@pytest.mark.parametrize("texts", [40, 4000])
def test_many_languages(spark, texts):
    rng = random.Random(9)
    langs = {f"l{i}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(12)] for i in range(9)}
    rows = make(5, 900, langs)
    truth = {r[0]: r[2] for r in rows}
    got = L.identify(spark.createDataFrame(rows, SCHEMA), sample_texts=texts).where("held_out").collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) / len(got) > 0.95


def test_edge_rows(spark, edge_docs, no_docs):
    got = {(r.doc_id, r.lang_pred, r.score) for r in L.identify(edge_docs).collect()}
    assert L.identify(edge_docs).count() == edge_docs.count()
    assert {(3, "und", 0.0), (4, "und", 0.0), (5, "und", 0.0), (None, "und", 0.0)} <= got
    assert all(p == "en" and s == 1.0 for d, p, s in got if d in (1, 2, 6, 7, 8, 9, 10))  # the only language learned
    assert L.identify(no_docs).count() == 0
    none = spark.createDataFrame([(0, "some text", None), (1, None, "en"), (2, "12 !", None)], SCHEMA)
    assert {tuple(r)[2:4] for r in L.identify(none).collect()} == {("und", 0.0)}
    long = spark.createDataFrame([(0, "ka lo mi " * 300_000, "aa"), (2, "schei ung " * 9, "bb"), (3, "1234 漢", "dd"), (7, "lo ka", None)], SCHEMA)
    assert {r.doc_id: r.lang_pred for r in L.identify(long).collect()}[0] == "aa"
