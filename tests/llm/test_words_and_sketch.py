import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm.sketch import Sketch, packed, runs_of, steps, unpacked
from starmart.llm.words import Words, flat, shingle_sets, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x1c\xa0abAB é漢", max_size=40)), max_size=8)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_equal_runs_have_equal_hashes(texts):
    column = flat(pa.array(texts, pa.string()))
    seen = {}
    words = Words(column)
    expected = [WORD.findall(t or "") for t in texts]
    assert words.count.tolist() == [len(w) for w in expected]
    starts = words.run_starts(3)
    hashes = dict(zip(starts.tolist(), words.runs(starts, 3).tolist(), strict=True))
    at = 0
    for own in expected:
        for i in range(len(own) - 2):
            run = tuple(own[i:i + 3])
            assert seen.setdefault(run, hashes[at + i]) == hashes[at + i]
        at += len(own)
    assert len(set(seen.values())) == len(seen)
    assert len(hashes) == sum(max(0, len(w) - 2) for w in expected)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingle_sets(texts):
    sets = shingle_sets(flat(pa.array(texts, pa.string())), 3, True)
    for text, got in zip(texts, sets, strict=True):
        w = WORD.findall(lowered(text or ""))
        want = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())
        assert len(got) == len(want) and np.all(got[1:] > got[:-1])


def test_slices_cover_all_rows():
    column = pa.array(["a" * 10, "", "b" * 100, "c", ""])
    assert list(slices(column, 12)) == [(0, 2), (2, 3), (3, 5)]
    assert list(slices(column[1:4], 1)) == [(0, 1), (1, 2), (2, 3)]
    assert list(slices(pa.array([], pa.string()))) == []


def test_packed_round_trip():
    for kind in (np.uint8, np.uint32, np.uint64, np.int64):
        values = np.sort(np.random.default_rng(1).integers(0, 200, 1000).astype(kind))
        assert np.array_equal(unpacked(packed(values), 1000, kind), values)
        assert np.array_equal(np.cumsum(unpacked(packed(steps(values)), 1000, kind), dtype=kind), values)
    assert len(unpacked(packed(np.zeros(0, np.uint64)), 0, np.uint64)) == 0
    assert runs_of(np.array([1, 1, 2])) == [(0, 2), (2, 3)] and runs_of(np.zeros(0)) == []


def test_sketch_never_underestimates():
    rng = np.random.default_rng(7)
    blocks = [np.unique(rng.integers(0, 3000, 1500).astype(np.uint64)) for _ in range(5)]
    true = {}
    for b in blocks:
        for h in b.tolist():
            true[h] = true.get(h, 0) + 1
    sketch = Sketch(11)
    asked = [sketch.ask(i, b, np.ones(len(b), np.int64)) for i, b in enumerate(blocks)]
    every = pa.concat_tables(asked).to_pandas()
    answers = [sketch.merge(pa.Table.from_pandas(g, preserve_index=False)) for _, g in every.groupby("shard")]
    answers = pa.concat_tables(answers).to_pandas()
    for i, b in enumerate(blocks):
        own = pa.Table.from_pandas(answers[answers.block == i].sample(frac=1, random_state=1), preserve_index=False)
        got = sketch.estimates(b, own)
        assert all(g >= true[h] for g, h in zip(got.tolist(), b.tolist(), strict=True))


def thue_morse(n, a="a", b="b"):
    """Two different words of n letters, n a power of 2, whose polynomial hashes modulo 2**64 are equal for n of 1024 or more."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_words_that_make_polynomials_collide():
    for n in (16, 32, 64, 1024, 2048, 4096):
        one, other = thue_morse(n)
        words = Words(pa.array([one, other]))
        assert words.hashes[0] != words.hashes[1] and words.checks[0] != words.checks[1]
    upper = Words(pa.array(["AB" * 40, "ab" * 40]), True)
    assert upper.hashes[0] == upper.hashes[1] and upper.checks[0] == upper.checks[1]
